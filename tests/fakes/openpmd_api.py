"""Stand-in for openpmd_api with the few calls the reader makes; series are JSON files."""

import json

import numpy as np


class Access:
    read_only = "r"


class _Chunk:
    def __init__(self, offset, extent):
        self.offset, self.extent = offset, extent


class _Record:
    def __init__(self, d):
        self._d, self.shape, self.position = d, d["shape"], d["position"]

    def available_chunks(self):
        return [_Chunk(o, e) for o, e in self._d["chunks"]]

    def load_chunk(self, off, ext):
        full = np.arange(np.prod(self.shape), dtype=float).reshape(self.shape) + self._d["base"]
        return full[tuple(slice(o, o + e) for o, e in zip(off, ext))]


class _Mesh(dict):
    def __init__(self, d):
        super().__init__({k: _Record(v) for k, v in d["components"].items()})
        self._attrs = d["attrs"]

    def get_attribute(self, name):
        return self._attrs[name]


class _Iteration:
    def __init__(self, d):
        self.meshes = {k: _Mesh(v) for k, v in d["meshes"].items()}
        if d.get("time") is not None:
            self.time = d["time"]

    def get_attribute(self, name):
        raise KeyError(name)


class Series:
    def __init__(self, path, access):
        with open(path) as f:
            self.iterations = {int(k): _Iteration(v) for k, v in json.load(f).items()}

    def flush(self):
        pass

    def close(self):
        pass
