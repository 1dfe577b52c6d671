"""How joins are planned: repeated sides stay on the executors, and views join on keys."""

import pytest

from nightloom.operators import linking as l
from nightloom.operators import proximity as p
from nightloom.operators import tuples as tu
from nightloom.plans import joins
from nightloom.plans.views import FOR_SPARK, VIEWS, Survey
from nightloom.sources import text as tx

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hash_joins(df):
    return [x for x in plan(df).splitlines() if "BroadcastHashJoin" in x]


def test_field_proximity_sends_no_side_to_the_driver(spark):
    v = Survey(spark, SF)
    assert not hash_joins(p.field_proximity(v.fields, joins._tracks(v), 0.2))


def test_field_on_a_knot_meets_its_track_once(spark):
    fields = spark.createDataFrame([(1, 55000.0, 10.0, 0.0, 3.0), (2, 55001.0, 11.0, 0.0, 3.0), (3, 55001.5, 11.5, 0.0, 3.0), (4, 55003.0, 13.0, 0.0, 3.0), (5, 55003.25, 13.0, 0.0, 3.0)], "field_id long, epoch_mjd double, ra_deg double, dec_deg double, fov_deg double")
    tracks = spark.createDataFrame([(9, 55000.0 + k, 10.0 + k, 0.0) for k in range(4)], "object_id long, epoch_mjd double, ra_deg double, dec_deg double")
    found = p.field_proximity(fields, tracks)
    assert sorted(r.field_id for r in found.collect()) == [1, 2, 3, 4]
    assert "Aggregate" not in plan(found)


def test_cone_sends_no_side_to_the_driver(spark):
    v = Survey(spark, SF)
    assert not hash_joins(p.fields_in_cone(joins._targets(v), v.fields, 0.5, 4.0))


def test_pairs_of_nights_without_a_tracklet_are_not_tried(spark):
    v = Survey(spark, SF)
    pairs = l.model_pairs(joins._whole_sky(v, (0, 3, 6)), 0.01, 0.01, 0.02, 0.002, 10.0)
    assert "SortMergeJoin [_cell" in plan(pairs)
    assert "night" in "".join(hash_joins(pairs)) and len(hash_joins(pairs)) == 2  # with the nights there are


@pytest.mark.parametrize("name", sorted(FOR_SPARK))
def test_view_for_spark_has_the_rows_of_its_sql(spark, name):
    v = Survey(spark, SF)
    got = getattr(v, name)
    want = spark.sql(VIEWS[name])
    assert got.schema.simpleString() == want.schema.simpleString()
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(got) == rows(want)


def test_views_join_on_keys(spark):
    v = Survey(spark, SF)
    assert "NestedLoop" not in plan(v.derivedobject_attrib) and "Cartesian" not in plan(v.derivedobject_attrib)
    assert ", p_partkey" not in plan(v.movers) and "night" in "".join(hash_joins(v.movers))


def test_exposures_of_two_footprints_at_one_place_are_not_mixed(spark):
    """Two cells' fours interleaved in time, as they are at larger sizes; and one group over many batches."""
    rows = [(100 * cell + k, 55000, cell, "r", 55000.4 + k / 80 + cell / 200, 10.0, 5.0, "OSS") for cell in (1, 2) for k in range(4)]
    fields = spark.createDataFrame(rows, "field_id long, nn long, p long, filter_id string, epoch_mjd double, ra_deg double, dec_deg double, survey_mode string")
    apart = {r.field_id: (r.kind, r.tuple_id, r.place) for r in tu.assemble_tuples(fields, 3, 4, 10, 30, within=("p",)).collect()}
    assert apart == {100 * c + k: ("TTI", 100 * c + 3, k) for c in (1, 2) for k in range(4)}
    stacks = {r.field_id: (r.kind, r.tuple_id) for r in tu.assemble_stacks(fields, 10, 30, within=("p",)).collect()}
    assert stacks == {100 * c + k: ("TUPLE", 100 * c + 3) for c in (1, 2) for k in range(4)}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        again = {r.field_id: (r.kind, r.tuple_id, r.place) for r in tu.assemble_tuples(fields, 3, 4, 10, 30, within=("p",)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert again == apart


def test_observation_at_24_hours_keeps_its_right_ascension(spark):
    df = spark.createDataFrame([("T1", 55000.5, ra, 5.0, 20.0, "r", "F51") for ra in (360.0, 359.99999999, 0.0)], "object_name string, epoch_mjd double, ra_deg double, dec_deg double, mag double, filter_id string, obscode string")
    lines = tx.format_obs80(df)
    assert {len(r.value) for r in lines.collect()} == {80}
    assert sorted(round(r.ra_deg, 6) for r in tx.parse_obs80(lines).collect()) == [0.0, 360.0, 360.0]


def test_observation_lines_keep_long_names(spark):
    """Names of up to eleven characters come back whole, longer ones are an error; a number is no part of the name."""
    kinds = "object_name string, epoch_mjd double, ra_deg double, dec_deg double, mag double, filter_id string, obscode string"
    names = ["", "T1", "T999999", "T1000000", "T1000001", "T10 000 001"]
    lines = tx.format_obs80(spark.createDataFrame([(n, 55000.5, 10.0, 5.0, 20.0, "r", "F51") for n in [*names, None]], kinds))
    assert {len(r.value) for r in lines.collect()} == {80}
    assert sorted(r.object_name for r in tx.parse_obs80(lines).collect()) == sorted([*names, ""])
    (plain,) = [r.value for r in lines.collect() if "T999999" in r.value]
    numbered = spark.createDataFrame([("00433" + plain[5:],), ("    C" + plain[5:],)], "value string")
    assert [r.object_name for r in tx.parse_obs80(numbered).collect()] == ["T999999", "CT999999"]
    with pytest.raises(Exception, match="longer than 11"):
        tx.format_obs80(spark.createDataFrame([("T10000000001", 55000.5, 10.0, 5.0, 20.0, "r", "F51")], kinds)).collect()


def test_a_crowded_cell_is_the_work_of_many_keys(spark):
    predictions = spark.createDataFrame([(k, 10.0 + k / 1000, 0.0, 19.0) for k in range(50)], "object_id long, ra_deg double, dec_deg double, mag double")
    pointings = spark.createDataFrame([(k, 10.0, 0.0) for k in range(20)], "pointing_id long, p_ra double, p_dec double")
    found = p.objects_in_view(predictions, pointings, 1.5, 20.0)
    assert found.count() == found.distinct().count() == 1000
    assert "_part" in plan(found)
