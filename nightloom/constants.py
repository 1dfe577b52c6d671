"""Code domains and physical constants of the survey tables."""

from __future__ import annotations

# Fixed values of the survey's tables.
DET_FOUND, DET_UNFOUND, DET_NEW = "F", "X", "U"
REMOVAL_CODES = {"silly": "S", "bright": "B", "low_s2n": "L", "dipole": "D", "dense": "K", "duplicate": "2", "interior": "I", "ota": "O"}
FIELD_STATUSES = ("I", "N", "D", "T", "U", "A", "K", "L", "X")
TRACKLET_UNATTRIBUTED, TRACKLET_ATTRIBUTED, TRACKLET_KILLED, TRACKLET_KNOWN = "U", "A", "K", "W"
OBJECT_NEW, OBJECT_MERGED, OBJECT_KEPT = "I", "M", "K"
EFF_UNFOUND, EFF_CLEAN, EFF_MIXED, EFF_BAD, EFF_NONSYNTHETIC = "X", "C", "M", "B", "N"
ORBIT_CODES = ("I", "D", "F", "J", "R", "Y")
QUEUE_CHAIN = ("N", "I", "P", "X")

MJD_JD = 2400000.5
LUNATION_ZERO_JD, LUNATION_DAYS = 2451564.5, 29.53058867
SITE_OFFSET_HOURS = -10.0

#: Added to a magnitude in a filter to give V.
TO_V = {"g": -0.28, "r": 0.23, "i": 0.39, "z": 0.37, "y": 0.36, "w": 0.16}
#: Zero points: the magnitude of one count a second.
ZERO_POINTS = {"g": 24.9, "r": 25.1, "i": 25.0, "z": 24.6, "y": 23.6}
BASE62 = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
JUPITER_AU = 5.20
