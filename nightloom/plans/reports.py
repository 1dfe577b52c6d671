"""Registered queries: reports and aggregations."""

from __future__ import annotations

from ..functions.photometry import predict_s2n
from ..operators import efficiency as e
from ..operators import selectors as s
from .common import CLASSES, F, Registry, r6, rounded

R = Registry()
NN = 55007

R.add("a1_eff_detections", lambda v: e.eff_detections(v.detections, v.fields, NN), f"""
SELECT field_id, count(*) FILTER (object_name LIKE 'S%') AS avail, count(*) FILTER (object_name LIKE 'S%' AND status='F') AS found, count(*) FILTER (object_name LIKE 'S%' AND status='X') AS unfound,
 count(*) FILTER (object_name LIKE 'S%' AND status='F') AS synthetic, count(*) FILTER (object_name IS NULL OR object_name NOT LIKE 'S%') AS nonsynthetic FROM detections WHERE nn={NN} GROUP BY field_id""")
R.add("a2_eff_tracklets_by_field", lambda v: e.eff_tracklets_by_field(v.tracklets, v.tracklet_attrib, v.movers, 55005.4), f"""
SELECT d.field_id, {CLASSES} FROM tracklets t LEFT JOIN tracklet_attrib a ON a.tracklet_id=t.tracklet_id LEFT JOIN movers d ON d.det_id=a.det_id WHERE t.ext_epoch >= 550054e-1 AND t.ext_epoch < 550064e-1 GROUP BY d.field_id""")
R.add("a3_eff_tracklets_by_night", lambda v: e.eff_tracklets_by_night(v.tracklets, v.fields, None), f"SELECT f.nn, {CLASSES} FROM tracklets t JOIN fields f ON f.field_id=t.field_id GROUP BY f.nn")
_hist = f"""{CLASSES}, CAST(sum(CASE WHEN classification='X' AND orbit_code='F' THEN 1 ELSE 0 END) AS BIGINT) AS unlinked, CAST(sum(CASE WHEN classification='X' AND orbit_code<>'F' THEN 1 ELSE 0 END) AS BIGINT) AS failod, CAST(0 AS BIGINT) AS failiod"""
for kind in "DAPI":
    R.add(f"a4_eff_history_{kind.lower()}_by_night", lambda v, k=kind: e.eff_history(v.history, v.fields, k), f"SELECT f.nn, {_hist} FROM history h JOIN fields f ON f.field_id=h.field_id WHERE event_type='{kind}' GROUP BY f.nn")
R.add("a4_eff_history_d_by_field", lambda v: e.eff_history(v.history, v.fields, "D", "field_id"), f"SELECT h.field_id, {_hist} FROM history h JOIN fields f ON f.field_id=h.field_id WHERE event_type='D' GROUP BY h.field_id")


def _derivations(key: str, source: str) -> str:
    return f"""WITH j AS (SELECT h.*, {source}),
c AS (SELECT k, count(*) AS clean, CAST(sum(n-1) AS BIGINT) AS duplicate FROM (SELECT k, derivedobject_id, count(*) AS n FROM j WHERE classification='C' GROUP BY 1,2) x GROUP BY k),
o AS (SELECT k, count(*) FILTER (classification='X') AS unfound, count(*) FILTER (classification='M') AS mixed, count(*) FILTER (classification='B') AS bad, count(*) FILTER (classification='N') AS nonsynthetic FROM j GROUP BY k)
SELECT coalesce(c.k,o.k) AS {key}, coalesce(clean,0) AS clean, coalesce(duplicate,0) AS duplicate, coalesce(unfound,0) AS unfound, coalesce(mixed,0) AS mixed, coalesce(bad,0) AS bad, coalesce(nonsynthetic,0) AS nonsynthetic FROM c FULL JOIN o ON c.k=o.k"""


R.add("a5_eff_derivations_by_night", lambda v: e.eff_derivations(v.history, v.fields.select("field_id", "nn"), "nn", "field_id"), _derivations("nn", "f.nn AS k FROM history h JOIN fields f ON f.field_id=h.field_id WHERE event_type='D'"))
R.add("a6_eff_derivations_by_field", lambda v: e.eff_derivations(v.history, v.fields.select("field_id"), "field_id", "field_id"), _derivations("field_id", "h.field_id AS k FROM history h JOIN fields f ON f.field_id=h.field_id WHERE event_type='D'"))
R.add("a7_eff_derivations_by_family", lambda v: e.eff_derivations(v.history, v.ssm.select(F.col("ssm_id").alias("derivedobject_id"), F.substring("object_name", 1, 2).alias("family")), "family", "derivedobject_id"), _derivations("family", "substr(s.object_name,1,2) AS k FROM history h JOIN ssm s ON s.ssm_id=h.derivedobject_id WHERE event_type='D'"))
R.add("a8_derivation_residuals", lambda v: e.derivation_residuals(v.derivedobjects, v.ssm), "SELECT classification, derivedobject_id, residual FROM derivedobjects o JOIN ssm s ON s.orbit_id=o.orbit_id")
R.add("a9_attribution_distances", lambda v: e.attribution_distances(v.history), "SELECT classification, event_id, ephemeris_distance FROM history WHERE event_type='A'")
R.add("a10_available_linkages", lambda v: e.available_linkages(v.tracklets, 2, 55000, 55020), "SELECT ssm_id, count(DISTINCT nn) AS nights FROM tracklets WHERE classification='C' AND nn BETWEEN 55000 AND 55020 AND ssm_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT nn)>=2")
R.add("a11_available_link2", lambda v: e.available_link2(v.tracklets, v.fields), "SELECT ssm_id, count(DISTINCT f.ocnum) AS lunations, count(DISTINCT t.nn) AS nights FROM tracklets t JOIN fields f ON f.field_id=t.field_id WHERE ssm_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT f.ocnum)>1 AND count(DISTINCT t.nn)>2")
R.add("a12_survey_mode_counts", lambda v: e.survey_mode_counts(v.fields), "SELECT nn, survey_mode, count(*) AS n FROM fields GROUP BY 1,2")
R.add("a13_status_summary", lambda v: e.status_summary(v.fields, v.tracklets), """
SELECT ocnum, nn, status, filter_id, survey_mode, count(*) AS n_fields, CAST(coalesce(sum(t),0) AS BIGINT) AS n_tracklets, CAST(grouping(nn) AS INT) AS by_mode FROM fields f LEFT JOIN (SELECT field_id, count(*) AS t FROM tracklets GROUP BY 1) x ON x.field_id=f.field_id
GROUP BY GROUPING SETS ((ocnum, nn, status),(filter_id, survey_mode))""")
R.add("a14_audit_reuse_tracklets", lambda v: s.audit_reuse(v.derivedobject_attrib, v.derivedobjects), "SELECT tracklet_id, count(*) AS n, count(DISTINCT classification) AS classes, min(derivedobject_id) AS first_object FROM (SELECT m.*, o.classification FROM derivedobject_attrib m JOIN derivedobjects o ON o.derivedobject_id=m.derivedobject_id WHERE o.status<>'M') x GROUP BY 1 HAVING count(*)>1")
R.add("a14_audit_reuse_detections", lambda v: s.audit_reuse(v.derivedobject_attrib, v.derivedobjects, v.tracklet_attrib), "SELECT det_id, count(*) AS n, count(DISTINCT classification) AS classes, min(derivedobject_id) AS first_object FROM (SELECT DISTINCT m.derivedobject_id, o.classification, a.det_id FROM derivedobject_attrib m JOIN derivedobjects o ON o.derivedobject_id=m.derivedobject_id JOIN tracklet_attrib a ON a.tracklet_id=m.tracklet_id WHERE o.status<>'M') x GROUP BY 1 HAVING count(*)>1")
R.add("a15_audit_references", lambda v: s.audit_references({"history": v.history, "fields": v.fields, "derivedobjects": v.derivedobjects, "derivedobject_attrib": v.derivedobject_attrib, "tracklets": v.tracklets}, [("history", "field_id", "fields"), ("history", "derivedobject_id", "derivedobjects"), ("derivedobject_attrib", "tracklet_id", "tracklets")]), """
SELECT 'history.field_id' AS rule, count(*) AS n FROM history WHERE field_id NOT IN (SELECT field_id FROM fields) UNION ALL SELECT 'history.derivedobject_id', count(*) FROM history WHERE derivedobject_id NOT IN (SELECT derivedobject_id FROM derivedobjects) UNION ALL SELECT 'derivedobject_attrib.tracklet_id', count(*) FROM derivedobject_attrib WHERE tracklet_id NOT IN (SELECT tracklet_id FROM tracklets)""")
R.add("a16_histogram", lambda v: rounded(e.histogram(v.detections, "s2n", 20, 40.0), "start", "share"), f"""
WITH x AS (SELECT least(s2n, 40e0) AS v FROM detections), b AS (SELECT min(v) AS lo, (max(v)-min(v))/20 AS size FROM x),
c AS (SELECT CAST(least(19, floor((v-lo)/size)) AS INT) AS bin, count(*) AS n FROM x, b GROUP BY 1), g AS (SELECT CAST(unnest(range(20)) AS INT) AS bin)
SELECT g.bin, {r6("lo+g.bin*size")} AS start, coalesce(n,0) AS n, CAST(sum(coalesce(n,0)) OVER (ORDER BY g.bin) AS BIGINT) AS cumulative, {r6("coalesce(n,0)/CAST((SELECT count(*) FROM x) AS DOUBLE)")} AS share FROM g CROSS JOIN b LEFT JOIN c ON c.bin=g.bin""")
R.add("a17_mean_std", lambda v: rounded(e.mean_std(v.detections, "mag", ["filter_id"]), "mean", "std"), f"SELECT filter_id, {r6('avg(mag)')} AS mean, {r6('stddev_pop(mag)')} AS std FROM detections GROUP BY 1")
R.add("a21_discoveries_by_lunation", lambda v: e.discoveries_by_lunation(v.submissions, ["A", "B", "C"]), """
WITH f AS (SELECT desig, min(nn) AS nn, arg_min(survey_group, (nn, survey_group)) AS g FROM submissions WHERE is_discovery=1 GROUP BY 1)
SELECT CAST(floor((floor(nn + 2400000e0) + 5e-1 - 24515645e-1) / 2953058867e-8 + 1e-11) AS BIGINT) AS ocnum, count(*) FILTER (g='A') AS "A", count(*) FILTER (g='B') AS "B", count(*) FILTER (g='C') AS "C" FROM f GROUP BY 1""")
R.add("a22_snr_magnitude_sample", lambda v: e.snr_magnitude_sample(v.movers, v.tracklet_attrib, v.tracklets, v.fields, "C", 55006), f"SELECT d.det_id, d.mag, d.s2n, f.filter_id AS filter FROM movers d JOIN tracklet_attrib a ON a.det_id=d.det_id JOIN tracklets t ON t.tracklet_id=a.tracklet_id JOIN fields f ON f.field_id=d.field_id WHERE t.classification='C' AND f.nn=55006")
R.add("a23_recoverable_by_lunation", lambda v: e.recoverable_by_lunation(v.detections, v.fields), """
WITH s AS (SELECT object_name, f.ocnum, count(DISTINCT d.nn) AS nights FROM detections d JOIN fields f ON f.field_id=d.field_id WHERE object_name IS NOT NULL GROUP BY 1,2),
m AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY object_name ORDER BY ocnum)=1 THEN 1 ELSE 0 END AS nw, substr(object_name,1,2) AS family FROM s),
b AS (SELECT ocnum, family, count(*) AS on1, count(*) FILTER (nights>=2) AS on2, count(*) FILTER (nights>=3) AS on3, CAST(sum(nw) AS BIGINT) AS "new" FROM m GROUP BY 1,2)
SELECT *, CAST(sum("new") OVER (PARTITION BY family ORDER BY ocnum) AS BIGINT) AS cumulative FROM b""")
for kind in "DAI":
    R.add(f"a24_chain_quality_{kind.lower()}", lambda v, k=kind: rounded(e.chain_quality(v.history, k, v.ssm.filter("q < 2.0")), "efficiency", "accuracy"), f"""
SELECT avail, found, clean, {r6("clean/CAST(avail AS DOUBLE)")} AS efficiency, {r6("clean/CAST(found AS DOUBLE)")} AS accuracy FROM (SELECT {CLASSES} FROM history WHERE event_type='{kind}' AND derivedobject_id IN (SELECT ssm_id FROM ssm WHERE q < 2e0)) x""")
R.add("a25_iod_efficiency", lambda v: rounded(e.iod_efficiency(v.history), "efficiency"), f"SELECT n, with_orbit, {r6('with_orbit/CAST(n AS DOUBLE)')} AS efficiency FROM (SELECT count(*) AS n, count(*) FILTER (orbit_code IN ('I','D')) AS with_orbit FROM history WHERE event_type='D' AND classification IN ('C','X')) x")
R.add("a26_s2n_scale_factor", lambda v: rounded(e.s2n_scale_factor(v.detections, v.fields, predict_s2n("simple", F.col("mag"))), "scale"), f"""
SELECT f.field_id, {r6("coalesce(scale,1e0)")} AS scale FROM fields f LEFT JOIN (SELECT field_id, avg(s2n/(2e0*100017e-5*pow(10e0, -2e-1*(2*mag-462e-1))*sqrt(30e0/pi()/36e-2))) AS scale FROM detections WHERE status='F' GROUP BY 1) x ON x.field_id=f.field_id""")
_groups = """(SELECT field_id, CASE WHEN s=0 THEN 'N' WHEN s=1 AND n=0 THEN 'C' WHEN n=0 THEN 'M' ELSE 'B' END AS classification, f1 FROM (SELECT field_id, count(DISTINCT CASE WHEN object_name LIKE 'S%' THEN object_name END) AS s, count(*) FILTER (object_name IS NULL OR object_name NOT LIKE 'S%') AS n, min(CASE WHEN object_name LIKE 'S%' THEN object_name END) AS f1 FROM detections GROUP BY 1) y)"""
R.add("a27_classify_groups", lambda v: e.classify_groups(v.detections, "field_id"), f"SELECT field_id, classification, CASE WHEN classification='C' THEN f1 END AS clean_name FROM {_groups} x")
R.add("a35_arc_length", lambda v: rounded(e.arc_length(s.detections_of_object(v.movers, v.tracklet_attrib, v.derivedobject_attrib), "derivedobject_id"), "arc_days"), f"SELECT derivedobject_id, {r6('max(epoch_mjd)-min(epoch_mjd)')} AS arc_days, count(*) AS n FROM derivedobject_attrib m JOIN tracklet_attrib a ON a.tracklet_id=m.tracklet_id JOIN movers d ON d.det_id=a.det_id GROUP BY 1")
R.add("a35_stable_objects", lambda v: e.stable_objects(v.predictions.withColumn("uncertainty", F.col("smaa_arcsec")), "object_id", 10.5), "SELECT object_id, max(smaa_arcsec) AS worst FROM predictions GROUP BY 1 HAVING max(smaa_arcsec) < 105e-1")
R.add("a36_visible_tracklets", lambda v: e.visible_tracklets(v.tracklets, v.tracklet_attrib, v.movers, [55001, 55005, 55009], 20.05), "SELECT t.tracklet_id, max(mag) AS faintest FROM tracklets t JOIN tracklet_attrib a ON a.tracklet_id=t.tracklet_id JOIN movers d ON d.det_id=a.det_id WHERE t.nn IN (55001,55005,55009) GROUP BY 1 HAVING max(mag) < 2005e-2")
R.add("a37_coverage_report", lambda v: e.coverage_report(v.fields, 3), "SELECT nn, coalesce(parent_id, field_id) AS tuple_id, arg_min(ra_deg, epoch_mjd) AS ra_deg, arg_min(dec_deg, epoch_mjd) AS dec_deg, count(*) AS exposures, max(limiting_mag) AS limiting_mag FROM fields GROUP BY 1,2 HAVING count(*)>=3")
_line = "'x TIMING ' || event_type || CASE WHEN user_id % 3 = 0 THEN '' ELSE '/p' || CAST(user_id % 4 AS VARCHAR(20)) END || ' ' || CAST(event_id % 50 AS VARCHAR(20)) || '.500 55000'"
R.add("a38_timing_summary", lambda v: rounded(e.timing_summary(v.events.select(F.expr(_line).alias("line"))), "percent"), f"""
WITH p AS (SELECT event_type AS section, CASE WHEN user_id % 3 = 0 THEN '' ELSE 'p' || CAST(user_id % 4 AS VARCHAR) END AS part, event_id % 50 + 5e-1 AS seconds FROM events), s AS (SELECT section, part, sum(seconds) AS seconds, CAST(grouping(section, part) AS INT) AS level FROM p GROUP BY ROLLUP(section, part))
SELECT *, {r6("100*seconds/(SELECT max(seconds) FROM s WHERE level=3)")} AS percent FROM s""")
R.add("a39_sky_density", lambda v: e.sky_density(v.detections, 5.0), "SELECT CAST(floor(ra_deg/5e0) AS BIGINT) AS ra_cell, CAST(floor(dec_deg/5e0) AS BIGINT) AS dec_cell, count(*) AS n FROM detections GROUP BY 1,2")
R.add("a40_observations_by_q", lambda v: s.observations_by_q(v.detections, v.ssm.filter("e > 0.9")), "SELECT det_id, d.object_name, mag, q FROM detections d JOIN ssm s ON s.object_name=d.object_name WHERE s.e > 9e-1")
R.add("a41_designation_counts", lambda v: s.designation_counts(v.submissions), "SELECT desig, count(*) AS n FROM submissions GROUP BY 1")
R.add("a42_link_summary", lambda v: rounded(e.link_summary(v.movers.select(F.col("pk").alias("track_id"), "nn", "object_name"), v.ssm.select("object_name")), "clean_percent"), f"""
WITH t AS (SELECT pk, count(DISTINCT nn) AS nights, count(DISTINCT object_name) AS names, min(object_name) AS nm FROM movers GROUP BY 1 HAVING count(DISTINCT nn)>2)
SELECT count(*) AS tracks, count(*) FILTER (names=1) AS clean, count(*) FILTER (names>1) AS mixed, (SELECT count(*) FROM ssm WHERE object_name NOT IN (SELECT nm FROM t WHERE names=1)) AS missed, {r6("100*count(*) FILTER (names=1)/CAST(count(*) AS DOUBLE)")} AS clean_percent FROM t""")
R.add("a43_linking_ledger", lambda v: e.linking_ledger(v.ssm, v.movers, v.ssm.filter("ssm_id % 3 = 0"), v.ssm.filter("ssm_id % 9 = 0")), "SELECT object_name, CASE WHEN ssm_id % 9=0 THEN 'final' WHEN ssm_id % 3=0 THEN 'initial' WHEN object_name IN (SELECT object_name FROM movers) THEN 'linked' ELSE 'unlinked' END AS stage FROM ssm")
R.add("a44_efficiency_report", lambda v: rounded(e.efficiency_report(e.eff_tracklets_by_night(v.tracklets, v.fields, None)), "percent"), f"""
WITH n AS (SELECT f.nn, {CLASSES} FROM tracklets t JOIN fields f ON f.field_id=t.field_id GROUP BY f.nn)
SELECT nn, CAST(sum(avail) AS BIGINT) AS avail, CAST(sum(found) AS BIGINT) AS found, CAST(sum(clean) AS BIGINT) AS clean, CAST(sum(mixed) AS BIGINT) AS mixed, CAST(sum(bad) AS BIGINT) AS bad, CAST(sum(nonsynthetic) AS BIGINT) AS nonsynthetic, {r6("100*sum(clean)/CAST(sum(avail) AS DOUBLE)")} AS percent FROM n GROUP BY ROLLUP(nn)""")
