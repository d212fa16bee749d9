"""Unit factors and physical constants.

Fixed values: they have to agree with published simulation output to the last
digit, so they are written out rather than derived.
"""

MSUN_TO_KM = 1.4766696910334391
MILLIS = 203.01930744592713
DENSITY_FACTOR = 1.61887093132742e-18
TEMPERATURE_FACTOR = 939.565
ENERGY_FACTOR = 1.7871477102628e54
HUNDRED_MPC = 100 * 3.0856775814913673e16 * 1e6 / 1476.6696910334393
VISCOSITY_FACTOR = 2.7338395629592487e33
J_START = 6.79368
M_START = 2.5592675
ORBITAL_OMEGA = 0.0087683725461739012
CUTOFF_FACTORS = (0.6, 0.8, 1.0, 1.2)

# Nuclear saturation density: two values are in use, so both are kept and the
# caller chooses.
RHO_SAT_CGS = 2.7e14
RHO_SAT_CGS_LOW = 1.66e14
RHO_SAT_GEOM = 0.0004029425588922455

DEFAULT_SCAN_EXCLUDED_DIRS = ("SIMFACTORY", "report", "movies", "tmp", "temp")
OPENPMD_EXTENSIONS = ("bp5", "bp", "bp4", "h5")
