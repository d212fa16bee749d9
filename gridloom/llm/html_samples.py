"""The labelled blocks from which the tree of `html_blocks` grows.

Made up by hand: each page is a list of blocks, one a line, `+` or `-` (article or not), the elements around it from the
outside in (`div.ad` is a div of class ad, `div#x` one with an id), its number of words and how many of them are in links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.html_blocks import FEATURES, blocks, features

PAGES = """
- nav/ul/li 1 1
- nav/ul/li 1 1
- nav/ul/li 2 2
- div.ad 9 0
+ article/h1 8 0
+ article/p 1 0
+ article/p 60 0
+ article/p 2 0
+ article/p 25 3
+ article/p 1 1
+ article/p 4 4
+ article/p 50 2
+ article/ul/li 3 3
+ article/ul/li 5 4
+ article/p 34 0
- footer 9 0

- header/div.logo 2 2
- header/nav/ul/li 1 1
- header/nav/ul/li 1 1
+ main/h1 6 0
+ main/p 45 0
+ main/h2 3 0
+ main/p 80 5
+ main/ul/li 3 0
+ main/ul/li 2 2
+ main/ul/li 12 1
+ main/blockquote/p 30 0
+ main/p 3 0
- main/aside/h3 2 0
- main/aside/p 40 0
- main/div.comments/h3 2 0
- main/div.comments/div.comment/p 35 0
- main/div.comments/div.comment/p 1 0
- footer/p 6 2
- footer/p 30 0

- div.cookie-notice/p 28 2
- div.header/h1 3 3
- div.menu/p 1 1
+ div.content/h1 7 0
+ div.content/p 55 2
+ div.content/p 1 0
+ div.content/table/tr/td 2 0
+ div.content/p 18 0
+ div.content/ul/li 4 4
+ div.content/p 2 2
+ div.content/p 40 0
- div.content/div.share 4 4
- div.content/div.related/h3 2 0
- div.content/div.related/ul/li 8 8
- div.sidebar/p 33 1
- div.footer/p 12 0

- header/h1 3 0
- header/p 6 0
- div.banner/p 14 0
- section.alert/p 20 0
+ div.layout-sidebar/article/header/h1 9 0
+ div.layout-sidebar/article/header/p 4 1
+ div.layout-sidebar/article/p 70 0
+ div.layout-sidebar/article/p 5 0
+ div.layout-sidebar/article/p 1 0
+ div.layout-sidebar/article/p 1 0
+ div.layout-sidebar/article/p 30 0
- div.layout-sidebar/article/form/label 3 0
- div.layout-sidebar/article/form/button 1 0
- div.layout-sidebar/article/div.advert/p 22 0
+ div.layout-sidebar/article/p 40 6
- div.layout-sidebar/article/footer/p 5 1
- div.layout-sidebar/aside/article/h3 4 4
- div.layout-sidebar/aside/article/p 20 0
- section.comments/article.comment/p 50 0
- section.comments/article.comment/div.comment-content/p 3 0
- section.comments/div.comment/div.body/p 26 0
- section#respond/form/label 2 0
- footer/div/p 15 0

- div/p 1 1
- div/p 1 1
- div/p 2 2
- div/ul/li 2 2
- div/ul/li 3 3
+ div/h1 7 0
+ div/p 64 1
+ div/p 35 0
+ div/p 28 3
+ div/p 90 8
+ div/h2 4 0
+ div/p 22 0
- div/p 4 4
- div/ul/li 2 2
- div/ul/li 1 1
- div/p 6 3

+ h1 6 0
+ p 30 0
+ p 44 0
+ p 15 0
+ p 71 2

+ div#main/h1 5 0
+ div#main/p 1 0
+ div#main/p 12 0
+ div#main/p 3 3
- div#main/div.ads 16 0
+ div#main/p 48 0
- div#main/ul.pagination/li 1 1
- div#nav/ul/li 2 0
- div#footer 25 1

- nav/div/p 2 2
- nav/div/p 1 0
+ main/article/h1 4 0
+ main/article/section/h2 3 0
+ main/article/section/p 33 0
+ main/article/section/p 1 0
+ main/article/figure/figcaption 7 0
+ main/article/div/p 52 4
+ main/article/div.post-body/p 20 0
+ main/article/div.post-body/p 6 6
+ main/article/div.post-body/p 58 1
+ main/article/div.entry-content/p 2 0
- main/article/nav/ul/li 3 3
- main/article/div.newsletter/p 19 0
- main/section.comments/h2 1 0
- main/section.comments/p 60 0
"""


def _element(step: str) -> tuple[str, str]:
    for sign, key in ((".", "class"), ("#", "id")):
        if sign in step:
            name, value = step.split(sign)
            return f'<{name} {key}="{value}">', f"</{name}>"
    return f"<{step}>", f"</{step}>"


def page_of(lines: list[str]) -> tuple[str, list[int]]:
    """HTML of one sample page and the labels of its blocks."""
    out, labels, path = ["<html><body>"], [], []
    for line in lines:
        label, where, words, linked = line.split()
        steps, shared = where.split("/"), 0
        # The innermost element is always a new one.
        while shared < min(len(path), len(steps) - 1) and path[shared] == steps[shared]:
            shared += 1
        out += [_element(s)[1] for s in reversed(path[shared:])]
        out += [_element(s)[0] for s in steps[shared:]]
        plain = " ".join(["word"] * (int(words) - int(linked)))
        out.append(f"{plain} <a href='#'>{' '.join(['link'] * int(linked))}</a>" if int(linked) else plain)
        path = steps
        labels.append(int(label == "+"))
    out += [_element(s)[1] for s in reversed(path)]
    return "".join(out) + "</body></html>", labels


def samples(spark: SparkSession) -> DataFrame:
    """Table of FEATURES and `kept`, one row per labelled block."""
    rows = []
    for lines in PAGES.strip().split("\n\n"):
        page, labels = page_of(lines.splitlines())
        rows += [(*map(float, x), y) for x, y in zip(features(blocks(page)).tolist(), labels, strict=True)]
    return spark.createDataFrame(rows, ", ".join(f"{f} double" for f in FEATURES) + ", kept int")
