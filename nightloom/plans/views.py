"""Survey tables derived from the driver's Parquet by integer arithmetic.

Each view is one SELECT that Spark and DuckDB both run, so a query and its DuckDB twin see the same rows. Operators do
not depend on these views: they take DataFrames with the survey's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("orders", "lineitem", "part", "customer", "events", "supplier", "nation")


def div(x: str, n: int) -> str:
    return f"CAST(floor(({x})/{n}e0) AS BIGINT)"


def pick(letters: str, x: str) -> str:
    """The letter of ``letters`` at ``x`` modulo their number."""
    return f"substr('{letters}', CAST(({x}) % {len(letters)} AS INT) + 1, 1)"


VIEWS: dict[str, str] = {
    "fields": f"""
        SELECT field_id, p, n, e, nn, epoch_mjd, ra_deg, dec_deg, filter_id, status, limiting_mag, fov_deg, 'F51' AS obscode, survey_mode,
               CAST(floor((floor(epoch_mjd + 2400000e0) + 5e-1 - 24515645e-1) / 2953058867e-8 + 1e-11) AS BIGINT) AS ocnum, parent_id
        FROM (SELECT field_id, p, n, e, 55000 + n AS nn, 55000 + n + 14e-1 + e / 80e0 + (p % 16) / 2000e0 AS epoch_mjd,
                     (p * 37 % 360) * 1e0 AS ra_deg, (p * 17 % 120) - 60e0 AS dec_deg, {pick("grizw", "p")} AS filter_id, {pick("NDTUAL", "field_id")} AS status,
                     22e0 + (p % 5) / 10e0 AS limiting_mag, 3e0 AS fov_deg,
                     CASE p % 3 WHEN 0 THEN '3PI' WHEN 1 THEN 'OSS' ELSE 'MD' END AS survey_mode, CASE WHEN e = 3 THEN NULL ELSE field_id - e + 3 END AS parent_id
              FROM (SELECT o_orderkey AS field_id, {div("o_orderkey", 120)} AS p, {div("o_orderkey", 4)} % 30 AS n, o_orderkey % 4 AS e FROM orders) AS x) AS y""",
    "detections": """
        SELECT det_id, field_id, epoch_mjd, nn, filter_id, obscode, CASE WHEN ra < 0 THEN ra + 360e0 WHEN ra >= 360 THEN ra - 360e0 ELSE ra END AS ra_deg, dec_deg, mag, s2n, 1e0 / s2n AS mag_sigma, object_name, status
        FROM (SELECT ok * 10 + k AS det_id, f.field_id, f.epoch_mjd, f.nn, f.filter_id, f.obscode,
                     f.ra_deg + ((ok * 7919 + least(k, 6) * 104729) % 20011 - 10005) / 10005e0 + (k - least(k, 6)) / 10000e0 AS ra,
                     f.dec_deg + ((ok * 6007 + least(k, 6) * 15485) % 20021 - 10010) / 10010e0 AS dec_deg,
                     18e0 + (pk % 60) / 10e0 AS mag, 3e0 + qty AS s2n,
                     CASE WHEN rf = 'R' THEN NULL ELSE 'S' || CAST(pk % 2 AS VARCHAR(20)) || '_' || CAST(pk AS VARCHAR(20)) END AS object_name, CASE WHEN ls = 'F' THEN 'F' ELSE 'X' END AS status
              FROM (SELECT l_orderkey AS ok, CAST(l_linenumber AS BIGINT) AS k, min(l_partkey) AS pk, CAST(min(l_quantity) AS BIGINT) AS qty, min(l_returnflag) AS rf, min(l_linestatus) AS ls
                    FROM lineitem GROUP BY l_orderkey, l_linenumber) AS l JOIN fields f ON l.ok = f.field_id) AS z""",
    "movers": f"""
        SELECT 10000000000 + pk * 1000 + n * 10 + e AS det_id, field_id, epoch_mjd, nn, p, n, e, pk, filter_id, obscode, limiting_mag,
               CASE WHEN ra < 0 THEN ra + 360e0 WHEN ra >= 360 THEN ra - 360e0 ELSE ra END AS ra_deg, dec AS dec_deg, 18e0 + (pk % 40) / 10e0 AS mag, 5e0 + pk % 30 AS s2n,
               'S' || CAST(pk % 2 AS VARCHAR(20)) || '_' || CAST(pk AS VARCHAR(20)) AS object_name
        FROM (SELECT p_partkey AS pk, f.*, f.ra_deg + ({div("p_partkey", 12)} % 41) * 6e-2 - 12e-1 + (({div("p_partkey", 12)} % 7) - 3) / 20e0 * (f.epoch_mjd - f.nn - 14e-1) AS ra,
                     f.dec_deg + ({div("p_partkey", 492)} % 41) * 6e-2 - 12e-1 + (({div("p_partkey", 12)} % 5) - 2) / 20e0 * (f.epoch_mjd - f.nn - 14e-1) AS dec
              FROM part JOIN fields f ON f.p = p_partkey % 12 AND (f.n = p_partkey % 30 OR f.n = (p_partkey + 3) % 30 OR f.n = (p_partkey + 6) % 30)) AS m""",
    "tracklet_attrib": "SELECT pk * 100 + n AS tracklet_id, det_id FROM movers",
    "tracklets": f"""
        SELECT pk * 100 + n AS tracklet_id, max(field_id) AS field_id, min(nn) AS nn, min(epoch_mjd) AS ext_epoch, count(*) AS n_dets, {pick("UAKW", "pk")} AS status, {pick("CXMBN", "pk")} AS classification,
               CASE WHEN pk % 5 < 2 THEN pk END AS ssm_id, (pk % 100) / 100e0 AS probability, (pk % 101) * 1e0 AS digest, ((pk * 7 + n) % 50) / 25e0 AS vel_tot, (pk % 13) / 10e0 AS gcr_arcsec, pk
        FROM movers GROUP BY pk, n""",
    "ssm": f"""
        SELECT p_partkey AS ssm_id, p_partkey AS orbit_id, 'S' || CAST(p_partkey % 2 AS VARCHAR(20)) || '_' || CAST(p_partkey AS VARCHAR(20)) AS object_name, 5e-1 + (p_partkey % 100) / 20e0 AS q, (p_partkey % 97) / 100e0 AS e, (p_partkey % 60) * 1e0 AS i,
               (p_partkey * 7 % 360) * 1e0 AS node, (p_partkey * 13 % 360) * 1e0 AS arg_peri, (54000 + p_partkey % 2000) * 1e0 AS time_peri, 55000e0 AS epoch, 10e0 + (p_partkey % 120) / 10e0 AS h_v,
               (p_partkey % 50) / 100e0 AS residual, (p_partkey % 40) / 200e0 AS moid_1, CASE WHEN p_partkey % 3 = 0 THEN (p_partkey % 50) / 100e0 END AS moid_2, (p_partkey % 200) * 1e0 AS arc_length, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE (p_partkey % 9) / 10000e0 END AS q_sigma
        FROM part""",
    "derivedobjects": f"""
        SELECT c_custkey AS derivedobject_id, 'L' || CAST(c_custkey AS VARCHAR(20)) AS object_name, c_custkey AS orbit_id, CASE c_custkey % 10 WHEN 9 THEN 'M' ELSE 'I' END AS status, {pick("CXMBN", "c_custkey")} AS classification,
               c_custkey AS ssm_id, 55000 + c_custkey % 30 AS updated_nn, CASE WHEN c_custkey % 4 = 1 THEN 'N' ELSE 'Y' END AS stable_pass FROM customer""",
    "derivedobject_attrib": """
        SELECT c_custkey AS derivedobject_id, t.tracklet_id FROM customer JOIN tracklets t ON t.pk = c_custkey OR (c_custkey % 10 = 0 AND t.pk = c_custkey + 1)""",
    "history": f"""
        SELECT ok * 10 + k AS event_id, ok AS field_id, {pick("DAPID", "k")} AS event_type, pk AS derivedobject_id, {pick("CXMBN", "ok + k")} AS classification, {pick("IDFJRY", "pk")} AS orbit_code, qty * 1e0 AS ephemeris_distance, qty, pk
        FROM (SELECT l_orderkey AS ok, CAST(l_linenumber AS BIGINT) AS k, min(l_partkey) AS pk, CAST(min(l_quantity) AS BIGINT) AS qty FROM lineitem GROUP BY l_orderkey, l_linenumber) AS h""",
    "eon_queue": f"SELECT c_custkey AS derivedobject_id, {pick('NIPX', 'c_custkey')} AS status, 100 + c_custkey AS queue_id FROM customer",
    "predictions": """
        SELECT pk AS object_id, field_id, epoch_mjd, CASE WHEN ra_deg + ((pk % 9) - 4) / 36e2 < 0 THEN ra_deg + ((pk % 9) - 4) / 36e2 + 360e0 ELSE ra_deg + ((pk % 9) - 4) / 36e2 END AS ra_deg, dec_deg + ((pk % 7) - 3) / 36e2 AS dec_deg, mag,
               5e0 + pk % 11 AS smaa_arcsec, 2e0 + pk % 5 AS smia_arcsec, (pk * 11 % 180) * 1e0 AS bearing_deg
        FROM movers WHERE e = 0""",
    "submissions": f"""
        SELECT event_id AS sub_id, 'L' || CAST(user_id AS VARCHAR(20)) AS desig, user_id, {pick("ABC", "event_id")} AS survey_group, event_id % 30 AS digest, 55000 + event_id % 90 AS nn, event_type, CAST(event_id % 7 = 0 AS INT) AS is_discovery FROM events""",
    # Exposures that tuples are made of: the fields' fours, and beside some of them one an hour too late, one a degree away, a fifth within the gap, and series two minutes apart.
    "exposures": """
        SELECT field_id * 10 AS field_id, p, n, e, 0 AS lot, nn, epoch_mjd, ra_deg, dec_deg, filter_id, survey_mode, status FROM fields
        UNION ALL SELECT field_id * 10 + 1, p, n, e, 1, nn, epoch_mjd + 1e0 / 24e0, ra_deg, dec_deg, filter_id, survey_mode, status FROM fields WHERE e = 3 AND p % 7 = 1
        UNION ALL SELECT field_id * 10 + 2, p, n, e, 2, nn, epoch_mjd + 4e-3, ra_deg, dec_deg + 1e0, filter_id, survey_mode, status FROM fields WHERE e = 1 AND p % 6 = 2
        UNION ALL SELECT field_id * 10 + 3, p, n, e, 3, nn, epoch_mjd + 14e0 / 1440e0, ra_deg, dec_deg, filter_id, survey_mode, status FROM fields WHERE e = 3 AND p % 5 = 3
        UNION ALL SELECT f.field_id * 10 + 4 + k, p, n, k, 4, nn, epoch_mjd + 1e-1 + k * 2e0 / 1440e0, ra_deg, dec_deg - 7e-1, filter_id, survey_mode, status FROM fields f JOIN (VALUES (0), (1), (2), (3), (4)) AS s(k) ON e = 0 AND p % 4 = 1""",
    "paths": """
        SELECT p_partkey AS id, k, k + 45e-2 + (p_partkey % 31) / 155e0 AS x, p_partkey * 13750776405e-8 AS r, (p_partkey * 7548776662e-10 - floor(p_partkey * 7548776662e-10)) * 100e0 - 50e0 AS d,
               (p_partkey * 7919 % 1009 - 504) / 3400e0 AS va, (p_partkey % 201 - 100) / 200000e0 AS aa, (p_partkey * 104729 % 997 - 498) / 6200e0 AS vd
        FROM part JOIN (VALUES (0), (3), (6), (9)) AS n(k) ON p_partkey > 0""",
    # Tracklets of objects on four nights; some lack a night or two, some have a false one beside a true one, some share their path with another, and false ones lie
    # anywhere, one of them very fast.
    "motions": """
        SELECT tracklet_id, t, ra - 360e0 * floor(ra / 360e0) AS ra, dec, va, vd
        FROM (SELECT id * 100 + k AS tracklet_id, 55000e0 + x AS t, r + va * x + aa * x * x AS ra, d + vd * x AS dec, va + 2 * aa * x AS va, vd FROM paths WHERE NOT (id % 11 = 3 AND k = 3) AND NOT (id % 13 = 5 AND k IN (3, 6))
              UNION ALL SELECT id * 100 + 50, 55000e0 + x, r + va * x + aa * x * x, d + vd * x + 15e-3, va + 2 * aa * x, vd FROM paths WHERE id % 17 = 0 AND k = 6
              UNION ALL SELECT id * 100 + 60, 55000e0 + x, r + 37e0, d * 9e-1 + 3e0, -va, vd + 1e-1 FROM paths WHERE id % 7 = 0 AND k = 3
              UNION ALL SELECT id * 100 + 65, 55000e0 + x, r + va * x + aa * x * x + 1e0, d + vd * x, va + 2e-1, vd FROM paths WHERE id % 23 = 0 AND k = 9
              UNION ALL SELECT id * 100 + 70 + k, 55000e0 + x, r + va * x + aa * x * x, d + vd * x + 5e-4, va + 2 * aa * x, vd FROM paths WHERE id % 19 = 0
              UNION ALL SELECT 7, 550035e-1, 10e0, 10e0, 50e0, 1e0 FROM paths WHERE id = 1 AND k = 3) AS m""",
}
ORDER = list(VIEWS)

#: Views whose joins are on anything but equal columns, said so that Spark can join on keys: the same rows by the same expressions. An object has three nights and only the first twelve
#: pointings, 1,440 fields whatever the survey's size, so those go to the objects, which are dealt over all tasks.
FOR_SPARK: dict[str, str] = {
    "movers": VIEWS["movers"].replace(
        "part JOIN fields f ON f.p = p_partkey % 12 AND (f.n = p_partkey % 30 OR f.n = (p_partkey + 3) % 30 OR f.n = (p_partkey + 6) % 30)",
        """(SELECT p_partkey, explode(array(p_partkey % 30, (p_partkey + 3) % 30, (p_partkey + 6) % 30)) AS night FROM part_dealt) AS o
                JOIN (SELECT * FROM fields WHERE p BETWEEN -11 AND 11) AS f ON f.p = p_partkey % 12 AND f.n = night""",
    ).replace("SELECT p_partkey AS pk, f.*", "SELECT /*+ BROADCAST(f) */ p_partkey AS pk, f.*"),
    "derivedobject_attrib": """
        SELECT derivedobject_id, t.tracklet_id
        FROM (SELECT c_custkey AS derivedobject_id, explode(CASE WHEN c_custkey % 10 = 0 THEN array(c_custkey, c_custkey + 1) ELSE array(c_custkey) END) AS member FROM customer) AS c JOIN tracklets t ON t.pk = member""",
}


def ctes(*needed: str) -> str:
    """``WITH`` clause of the views, for DuckDB; unused ones cost nothing there."""
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in ORDER)


def sql(query: str) -> str:
    """A DuckDB query over the views."""
    query = query.strip()
    return f"{ctes()},\n{query[4:].lstrip()}" if query[:4].upper() == "WITH" else f"{ctes()}\n{query}"


class Survey:
    """The survey tables of one directory, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in VIEWS:
                for other in [*BASE, *ORDER[: ORDER.index(name)]]:
                    if other in VIEWS[name]:
                        getattr(self, other).createOrReplaceTempView(other)
                if name == "movers":  # one number a row: a file of few row groups would keep most tasks idle
                    self.part.select("p_partkey").repartition(3 * self.spark.sparkContext.defaultParallelism, "p_partkey").createOrReplaceTempView("part_dealt")
                self._made[name] = self.spark.sql(FOR_SPARK.get(name, VIEWS[name]))
            else:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._made[name]


def r6(x: str) -> str:
    """Rounding that both engines do alike."""
    return f"(floor(({x})*1e6+5e-1)/1e6)"
