"""References, directions and geometry."""

import math

import pytest
from pyspark.sql import functions as F

from roadmill.functions import geo, refs
from roadmill.operators import relations


def each(spark, values, column, schema="v string"):
    """column(v) of each value, by value."""
    rows = spark.createDataFrame([(v,) for v in values], schema).select("v", column(F.col("v")).alias("out")).collect()
    return {r.v: r.out for r in rows}


HIGHWAYS = {
    "I 95": "I-95", "I-95": "I-95", "I95": "I-95", "I - 95": "I-95", "i 10": "I-10", "I 210 EXPR": "I-210", "I 25 Express": "I-25", "I 30 HOV": "I-30", "I 635 TEXpress": "I-635", "I 195 East": "I-195", "I 680 South": "I-680",
    "I 80 Local": "I-80", "US 1": "US-1", "US-90": "US-90", "US - 90": "US-90", "NC 40": "NC-40", "FL-826": "FL-826", "NC - 40": "NC-40", "FL 91 Toll": "FL-91 Toll", "I-95A": "I-95A", "CA 210": "I-210", "CA-210": "I-210",
    "VA 164": "I-164", "CA 99": "CA-99", "  I   80  ": "I-80", "": None, "   ": None, None: None, "Main Street": "Main Street", "us66a": "US-66A", "CA 210 Toll": "CA-210 Toll", "i-35e": "I-35E",
}


def test_highway_refs(spark):
    assert each(spark, HIGHWAYS, refs.normalize_highway_ref) == HIGHWAYS
    got = each(spark, ["I 80 BUS", "I 40 Business", "I-80", "i 5", "US 1", "I 80 Toll", "I-"], refs.is_interstate)
    assert got == {"I 80 BUS": False, "I 40 Business": False, "I-80": True, "i 5": True, "US 1": False, "I 80 Toll": False, "I-": False}
    assert each(spark, ["I 9;US 1;;I 9", None, " ; "], refs.split_refs) == {"I 9;US 1;;I 9": ["I-9", "US-1"], None: [], " ; ": []}
    assert each(spark, ["I-95", "I-35E", "US-1", "I-0"], refs.highway_number) == {"I-95": 95, "I-35E": 0, "US-1": 0, "I-0": 0}
    assert each(spark, ["I-35E", "I-35", " i-69c ", "I-35A", "US-1", "I5"], refs.is_exported) == {"I-35E": True, "I-35": True, " i-69c ": True, "I-35A": False, "US-1": False, "I5": True}
    assert each(spark, ["I 30", "30", "i-30a", "US 30", "I 30 Spur", None], refs.relation_ref) == {"I 30": "I-30", "30": "I-30", "i-30a": "I-30A", "US 30": None, "I 30 Spur": None, None: None}


DIRECTIONS = {"south (local)": "south", "north (thru)": "north", "South": "south", "eastbound": "east", "westbound": "west", "forward": None, "n": "north", "northeast": None, "east%20x": "east", "": None, None: None, "West;x": "west"}


def test_directions(spark):
    assert each(spark, DIRECTIONS, refs.direction) == DIRECTIONS
    assert {k: relations.direction_of(k) for k in DIRECTIONS} == DIRECTIONS
    assert each(spark, ["south (local)", "S", "Northbound"], lambda c: refs.direction(c, rich=False)) == {"south (local)": None, "S": "south", "Northbound": "north"}
    assert each(spark, ["forward", "Backward:1", "forwards", ""], refs.flow_role) == {"forward": "forward", "Backward:1": "backward", "forwards": None, "": None}
    assert each(spark, ["a+b", "a%2Bb", "100%", None], refs.percent_decode) == {"a+b": "a+b", "a%2Bb": "a+b", "100%": "100%", None: None}


TRUTH = {
    "19A,B": ["19A", "19B"], "12A,12B": ["12A", "12B"], "99A&B": ["99A", "99B"], "10B&A": ["10B", "10A"], "167 A&B": ["167A", "167B"], "99A&amp;B": ["99A", "99B"], "228 / 229": ["228", "229"], "13A/B": ["13A", "13B"], "143A;143B": ["143A", "143B"],
    "64A;B": ["64A", "64B"], "1A-1B": ["1A", "1B"], "14-14A-14B": ["14", "14A", "14B"], "108A-B": ["108A", "108B"], "267B-A": ["267A", "267B"], "214AB": ["214A", "214B"], "30BC": ["30B", "30C"], "29N": ["29"], "4A?B": ["4A", "4B"], "68A to 1A": ["68A", "1A"],
    "437 I-35W": ["437 I", "35W"], "437 Main": ["437"], "12": [], "12A": [], "": [], "North Exit": [], "1ABCDE": [],
}


def test_truth_refs(spark):
    assert each(spark, TRUTH, refs.expand_truth_ref) == TRUTH
    signs = {"Rest Area 5": True, "Truck Parking": True, "to I-5": True, "12A": False, "Toward Ohio": True, "Port of Entry": True}
    assert each(spark, signs, refs.is_non_exit) == signs
    assert each(spark, ["I-35E", "I-95A", "I-480N", "I-35"], refs.strip_highway_suffix) == {"I-35E": "I-35", "I-95A": None, "I-480N": "I-480", "I-35": None}


def test_exit_refs(spark):
    ranges = {"17A-B": ["17A", "17B"], "17A-C": ["17A", "17B", "17C"], "17C-A": ["17A", "17B", "17C"], "17A-G": [], "17A-F": ["17A", "17B", "17C", "17D", "17E", "17F"], "17": [], "A-B": [], "17A": [], "17A - B": ["17A", "17B"], None: []}
    assert each(spark, ranges, refs.letter_range) == ranges
    commas = {"11A,B": ["11A", "11B"], "12A,12B": ["12A", "12B"], "A,B": [], "7": [], "7, ,8": ["7", "8"]}
    assert each(spark, commas, refs.comma_parts) == commas
    bases = {"100B": "100", "100": "100", "AB": None, "10-A": None, "": None}
    assert each(spark, bases, refs.base_number) == bases


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_geometry(spark):
    at = lambda *v: [F.lit(float(x)) for x in v]
    far, same, north, east, asin, clamped = one(
        spark, geo.haversine_m(*at(40.7128, -74.0060, 34.0522, -118.2437)), geo.haversine_m(*at(35, -80, 35, -80)), geo.bearing(*at(35, -80, 36, -80)), geo.bearing(*at(35, -80, 35, -79)),
        geo.haversine_m(*at(40, -75, 40.01, -75), form="asin"), geo.haversine_m(*at(40, -75, 40.01, -75), form="asin_clamped"),
    )
    assert abs(far - 3_944_000) < 10_000 and same < 0.001
    assert min(north, 360 - north) < 1 and abs(east - 90) < 1.5
    assert asin == pytest.approx(1111.949, abs=0.01) and clamped == pytest.approx(asin)
    end, side = one(spark, geo.segment_m(*at(40, -74, 40, -74, 40.01, -74)), geo.segment_m(*at(40.005, -74.01, 40, -74, 40.01, -74)))
    assert end < 1 and 500 < side < 1500


def test_spheroid_metres(spark):
    """Against the meridian arc and the parallel's length at 60 degrees."""
    north, east = one(spark, geo.spheroid_m(*(F.lit(x) for x in (60.0, 10.0, 60.01, 10.0))), geo.spheroid_m(*(F.lit(x) for x in (60.0, 10.0, 60.0, 10.01))))
    assert north == pytest.approx(1114.15, abs=0.05) and east == pytest.approx(558.0, abs=0.05)


def test_paths(spark):
    points = spark.createDataFrame([([(40.0, -74.0), (40.01, -74.0), (40.01, -73.99)],), ([(1.0, 2.0)],), ([],)], "p array<struct<lat:double,lon:double>>")
    rows = points.select(geo.path_m(F.col("p")).alias("m"), geo.linestring_wkt(F.col("p")).alias("w"), *geo.bounds(F.col("p"))).collect()
    assert rows[0].m == pytest.approx(1111.949 + 851.4, abs=1) and rows[1].m == rows[2].m == 0
    assert rows[0].w == "LINESTRING(-74.0 40.0, -74.0 40.01, -73.99 40.01)"
    assert (rows[0].min_lat, rows[0].max_lon) == (40.0, -73.99)
    assert each(spark, [0.0, 44.9, 45.0, 134.0, 135.0, 225.0, 314.0, 315.0], geo.cardinal, "v double") == {0.0: "N", 44.9: "N", 45.0: "E", 134.0: "E", 135.0: "S", 225.0: "W", 314.0: "W", 315.0: "N"}
    assert each(spark, [0.2, 1.5, 2.5], geo.edge_weight_m, "v double") == {0.2: 1, 1.5: 2, 2.5: 3}
    lat, lon = one(spark, *geo.destination(F.lit(40.0), F.lit(-75.0), F.lit(90.0), 1000.0))
    assert lat == pytest.approx(40.0, abs=1e-4) and lon == pytest.approx(-75 + 1000 / (111_195 * math.cos(math.radians(40))), abs=1e-4)
