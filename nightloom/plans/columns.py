"""Registered queries: derived columns and selections."""

from __future__ import annotations

from ..functions import orbits as o
from ..functions import photometry as ph
from ..functions import sky
from ..functions import timefn as tf
from ..operators import cleaning as c
from ..operators import selectors as s
from .common import F, Registry, r6, rounded, sep

R = Registry()
C = F.col

R.add("p1_night_number", lambda v: v.detections.select("det_id", tf.night_number(C("epoch_mjd"), -10.0).alias("night"), tf.night_start(tf.night_number(C("epoch_mjd"), -10.0), -10.0).alias("start")).transform(rounded, "start"), f"SELECT det_id, CAST(floor(epoch_mjd-5e-1-10/24e0) AS BIGINT) AS night, {r6('floor(epoch_mjd-5e-1-10/24e0)+5e-1+10/24e0')} AS start FROM detections")
R.add("p2_lunation", lambda v: v.fields.select("field_id", tf.lunation(C("epoch_mjd")).alias("oc"), tf.lunation_start(tf.lunation(C("epoch_mjd"))).alias("start")), "SELECT field_id, ocnum AS oc, floor(24515645e-1+2953058867e-8*ocnum)-24000005e-1 AS start FROM fields")
R.add("p3_times", lambda v: v.fields.select("field_id", tf.mjd_to_utc(C("epoch_mjd") + 0.1 / 86400).alias("utc"), tf.mjd_to_local(C("epoch_mjd") + 0.1 / 86400, -10.0, " ").alias("local"), tf.mjd_to_jd(C("epoch_mjd")).alias("jd"), tf.ut_to_mjd(F.lit(2009), F.lit(7), (C("field_id") % 28 + 1).cast("int"), F.lit(6), F.lit(30), F.lit(0)).alias("ut")).transform(rounded, "jd"), f"""
SELECT field_id, strftime(make_timestamp(CAST(floor((epoch_mjd+1e-1/86400)*86400e0+5e-1) AS BIGINT)*1000000 - 3506716800000000), '%Y-%m-%dT%H:%M:%S') || '.0Z' AS utc, strftime(make_timestamp(CAST(floor((epoch_mjd+1e-1/86400-10/24e0)*86400e0+5e-1) AS BIGINT)*1000000 - 3506716800000000), '%Y-%m-%d %H:%M:%S') || '.0' AS local,
 {r6("epoch_mjd+24000005e-1")} AS jd, 55013e0 + field_id % 28 + (6*60+30)*60/86400e0 AS ut FROM fields""")
R.add("p4_hms_dms", lambda v: v.ssm.select("ssm_id", sky.hms(C("node") + 0.123).alias("hms"), sky.dms(C("i") - 30.0 + 0.0042).alias("dms")), """
WITH h AS (SELECT ssm_id, (node+123e-3)/15e0 AS h, abs(i-30e0+42e-4) AS d, i-30e0+42e-4 AS d0 FROM ssm), m AS (SELECT *, (h-floor(h))*60e0 AS m, (d-floor(d))*60e0 AS dm FROM h)
SELECT ssm_id, printf('%02d:%02d:%06.3f', CAST(floor(h) AS INT), CAST(floor(m) AS INT), (m-floor(m))*60e0) AS hms, (CASE WHEN d0<0 THEN '-' ELSE '+' END) || printf('%02d:%02d:%05.2f', CAST(floor(d) AS INT), CAST(floor(dm) AS INT), (dm-floor(dm))*60e0) AS dms FROM m""")
R.add("p5_normalize_radec", lambda v: v.ssm.select("ssm_id", sky.normalize_radec(C("node") * 3 - 400, C("arg_peri") - 170)[0].alias("ra"), sky.normalize_radec(C("node") * 3 - 400, C("arg_peri") - 170)[1].alias("dec")), """
WITH a AS (SELECT ssm_id, node*3-400 AS ra, arg_peri-170 AS d FROM ssm), b AS (SELECT ssm_id, ra, (d+180)-360e0*floor((d+180)/360e0)-180 AS d FROM a), c AS (SELECT ssm_id, ra + CASE WHEN abs(d)>90 THEN 180e0 ELSE 0e0 END AS ra, CASE WHEN d>90 THEN 180-d WHEN d<-90 THEN -180-d ELSE d END AS dec FROM b)
SELECT ssm_id, ra-360e0*floor(ra/360e0) AS ra, dec FROM c""")
R.add("p6_angle_diff", lambda v: v.ssm.select("ssm_id", sky.angle_diff(C("node"), C("arg_peri")).alias("d")), "SELECT ssm_id, CASE WHEN node-arg_peri > 180 THEN node-arg_peri-360 WHEN node-arg_peri <= -180 THEN node-arg_peri+360 ELSE node-arg_peri END AS d FROM ssm")
R.add("p7_separation_bearing", lambda v: v.detections.join(v.fields.select("field_id", C("ra_deg").alias("fr"), C("dec_deg").alias("fd")), "field_id").select("det_id", sky.separation(C("fr"), C("fd"), C("ra_deg"), C("dec_deg")).alias("d"), sky.bearing(C("fr"), C("fd"), C("ra_deg"), C("dec_deg")).alias("b")).transform(rounded, "d", "b"), f"""
SELECT det_id, {r6(sep("f.ra_deg", "f.dec_deg", "d.ra_deg", "d.dec_deg"))} AS d, {r6("b-360e0*floor(b/360e0)")} AS b FROM (SELECT d.*, degrees(atan2(sin(radians(d.ra_deg-f.ra_deg))*cos(radians(d.dec_deg)), cos(radians(f.dec_deg))*sin(radians(d.dec_deg))-sin(radians(f.dec_deg))*cos(radians(d.dec_deg))*cos(radians(d.ra_deg-f.ra_deg)))) AS b FROM detections d JOIN fields f ON f.field_id=d.field_id) d JOIN fields f ON f.field_id=d.field_id""")
_tp = """(SELECT d.det_id, d.field_id, d.ra_deg AS ra, d.dec_deg AS dec, f.ra_deg AS fr, f.dec_deg AS fd, f.fov_deg AS fov, cos(radians(d.dec_deg))*sin(radians(d.ra_deg-f.ra_deg))/dp AS xi, (cos(radians(f.dec_deg))*sin(radians(d.dec_deg))-sin(radians(f.dec_deg))*cos(radians(d.dec_deg))*cos(radians(d.ra_deg-f.ra_deg)))/dp AS eta, dp FROM (SELECT d.*, sin(radians(f.dec_deg))*sin(radians(d.dec_deg))+cos(radians(f.dec_deg))*cos(radians(d.dec_deg))*cos(radians(d.ra_deg-f.ra_deg)) AS dp FROM detections d JOIN fields f ON f.field_id=d.field_id) d JOIN fields f ON f.field_id=d.field_id)"""


def _with_field(v):
    return v.detections.join(v.fields.select("field_id", C("ra_deg").alias("fr"), C("dec_deg").alias("fd"), "fov_deg"), "field_id")


R.add("p8_in_field", lambda v: _with_field(v).select("det_id", sky.in_field(C("fr"), C("fd"), F.lit(1.7), C("ra_deg"), C("dec_deg")).alias("circle"), sky.in_square_field(C("fr"), C("fd"), F.lit(1.3), C("ra_deg"), C("dec_deg")).alias("square")), f"SELECT det_id, {sep('fr', 'fd', 'ra', 'dec')} < 85e-2 AS circle, dp>0 AND abs(xi) < radians(13e-1)/2 AND abs(eta) < radians(13e-1)/2 AS square FROM {_tp} x")
R.add("p9_in_ellipse", lambda v: _with_field(v).select("det_id", sky.in_ellipse(C("fr"), C("fd"), F.lit(0.8), F.lit(0.3), C("det_id") % 180 * 1.0, C("ra_deg"), C("dec_deg"), 0.05).alias("inside")), """
WITH e AS (SELECT det_id, (CASE WHEN ra-fr>180 THEN ra-fr-360 WHEN ra-fr<=-180 THEN ra-fr+360 ELSE ra-fr END)*cos(radians(fd)) AS x, dec-fd AS y, radians((det_id % 180)*1e0) AS b FROM (SELECT d.det_id, d.ra_deg AS ra, d.dec_deg AS dec, f.ra_deg AS fr, f.dec_deg AS fd FROM detections d JOIN fields f ON f.field_id=d.field_id) q)
SELECT det_id, pow((x*sin(b)+y*cos(b))/85e-2,2)+pow((x*cos(b)-y*sin(b))/35e-2,2) <= 1 AS inside FROM e""")
R.add("p10_xy_index", lambda v: _with_field(v).select("det_id", sky.xy_index(C("fr"), C("fd"), C("fov_deg"), 20, C("ra_deg"), C("dec_deg")).alias("cell")), f"SELECT det_id, CAST(CASE WHEN dp>0 THEN greatest(0,least(19,floor((eta+radians(fov)/2)/radians(fov)*20)))*20 + greatest(0,least(19,floor((xi+radians(fov)/2)/radians(fov)*20))) ELSE 200 END AS INT) AS cell FROM {_tp} x")
R.add("p11_annotate_fields", lambda v: v.fields.select("field_id", sky.ecliptic_latitude(C("epoch_mjd"), C("ra_deg"), C("dec_deg")).alias("ecl"), sky.galactic_latitude(C("ra_deg"), C("dec_deg")).alias("gal"), sky.solar_elongation(C("epoch_mjd"), C("ra_deg"), C("dec_deg")).alias("elong")).transform(rounded, "ecl", "gal", "elong"), f"""
WITH a AS (SELECT *, radians(23439291e-6-130042e-7*(epoch_mjd-515445e-1)/36525e0) AS t, radians(357528e-3+9856003e-7*(epoch_mjd-515445e-1)) AS g, 280460e-3+9856474e-7*(epoch_mjd-515445e-1) AS l0, radians(23439e-3-4e-7*(epoch_mjd-515445e-1)) AS t2 FROM fields),
b AS (SELECT *, radians(l0+1915e-3*sin(g)+20e-3*sin(2*g)) AS l FROM a), c AS (SELECT *, degrees(atan2(cos(t2)*sin(l), cos(l))) AS sr, degrees(asin(sin(t2)*sin(l))) AS sd FROM b)
SELECT field_id, {r6("degrees(asin(sin(radians(dec_deg))*cos(t)-cos(radians(dec_deg))*sin(t)*sin(radians(ra_deg))))")} AS ecl, {r6("degrees(asin(sin(radians(dec_deg))*sin(radians(2712825e-5))+cos(radians(dec_deg))*cos(radians(2712825e-5))*cos(radians(ra_deg-19285948e-5))))")} AS gal, {r6(sep("ra_deg", "dec_deg", "sr", "sd"))} AS elong FROM c""")
_v = "CASE filter_id WHEN 'g' THEN -28e-2 WHEN 'r' THEN 23e-2 WHEN 'i' THEN 39e-2 WHEN 'z' THEN 37e-2 WHEN 'y' THEN 36e-2 WHEN 'w' THEN 16e-2 ELSE 0e0 END"
R.add("p12_to_v", lambda v: v.detections.select("det_id", ph.to_v(C("mag"), C("filter_id")).alias("v"), ph.from_v(C("mag"), C("filter_id")).alias("m")).transform(rounded, "v", "m"), f"SELECT det_id, {r6(f'mag+{_v}')} AS v, {r6(f'mag-{_v}')} AS m FROM detections")
_z = "CASE filter_id WHEN 'g' THEN 249e-1 WHEN 'r' THEN 251e-1 WHEN 'i' THEN 250e-1 WHEN 'z' THEN 246e-1 WHEN 'y' THEN 236e-1 END"


def _fluxes(v):
    flux, sigma = ph.mag_to_flux(C("mag"), C("s2n"), C("filter_id"))
    flux2, sigma2, s2 = ph.magsig_to_flux(C("mag"), C("mag_sigma"), C("filter_id"))
    made = v.detections.select("det_id", "filter_id", flux.alias("flux"), sigma.alias("sigma"), sigma2.alias("sigma2"), s2.alias("s2n2"))
    back = ph.flux_to_mag(C("flux"), C("sigma"), C("filter_id"))
    return rounded(made.select("det_id", "flux", "sigma", "sigma2", "s2n2", back[0].alias("mag"), back[1].alias("mag_sigma")), "flux", "sigma", "sigma2", "s2n2", "mag", "mag_sigma")


R.add("p13_fluxes", _fluxes, f"""
WITH a AS (SELECT det_id, s2n, mag_sigma AS ms, pow(10e0,(mag-({_z}))/-25e-1) AS flux, {_z} AS z FROM detections)
SELECT det_id, {r6("flux")} AS flux, {r6("flux/s2n")} AS sigma, {r6("abs(ms*flux*ln(10e0)/25e-1)")} AS sigma2, {r6("flux/abs(ms*flux*ln(10e0)/25e-1)")} AS s2n2, {r6("-25e-1*log10(flux)+z")} AS mag, {r6("abs(25e-1*(flux/s2n)/(flux*ln(10e0)))")} AS mag_sigma FROM a""")
_s = "2e0*100017e-5*pow(10e0, -2e-1*(2*mag-{z}{d}))*sqrt({t}/pi()/pow({w},2))"
R.add("p14_predict_s2n", lambda v: v.detections.select(
    "det_id", ph.predict_s2n("simple", C("mag")).alias("a"), ph.predict_s2n("filter", C("mag"), exposure_s=45, zero=47.0).alias("b"), ph.predict_s2n("exposure", C("mag"), exposure_s=45, fwhm=1.1, diff_mag=0.2).alias("c"),
    ph.predict_s2n("counts", C("mag"), zero=25.0 + 8, fwhm=4.0, sky=300.0).alias("d"), ph.predict_s2n("scaled", C("mag"), zero=33.0, fwhm=4.0, sky=300.0, scale=0.9).alias("e")).transform(rounded, "a", "b", "c", "d", "e"), f"""
WITH f AS (SELECT *, pow(10e0,4e-1*(33-mag))*(1-exp(-1/(2*(16/55452e-4)))) AS fl FROM detections), g AS (SELECT *, fl/sqrt(fl+2*pi()*(300+pow(555e-2,2)+289e-3)) AS sn FROM f)
SELECT det_id, {r6(_s.format(z="462e-1", d="", t="30e0", w="6e-1"))} AS a, {r6(_s.format(z="47e0", d="", t="45e0", w="6e-1"))} AS b, {r6(_s.format(z="462e-1", d="+2e-1", t="45e0", w="11e-1"))} AS c, {r6("sn")} AS d, {r6("sn*9e-1")} AS e FROM g""")
R.add("p15_errors", lambda v: v.detections.select("det_id", ph.astro_error(C("s2n")).alias("a"), ph.photo_error(C("s2n")).alias("p"), ph.astro_error_px(C("s2n"), F.lit(0.05), F.lit(-0.25)).alias("x")).transform(rounded, "a", "p", "x"), f"SELECT det_id, {r6('CASE WHEN s2n<=15e-1 THEN 15e-1 ELSE 7e-2*(5e0/s2n) END')} AS a, {r6('-25e-1*log10(1-1/greatest(s2n,15e-1))')} AS p, {r6('sqrt(25e-4+pow(25e-2*269230e-6*(5e0/s2n),2))')} AS x FROM detections")
_draw = lambda k: f"sqrt(-2*ln(1-CAST('0x' || substr(h{k}, 1, 13) AS BIGINT)/4503599627370496e0))"
_turn = lambda k: f"2*pi()*CAST('0x' || substr(h{k}, 14, 13) AS BIGINT)/4503599627370496e0"
R.add("p16_perturb_positions", lambda v: rounded(ph.perturb_positions(v.detections, 7).select("det_id", "ra_deg", "dec_deg", "mag", "ra_sigma_deg", "mag_sigma"), "ra_deg", "dec_deg", "mag", "ra_sigma_deg", "mag_sigma"), f"""
SELECT det_id, {r6(f"ra_deg+a*{_draw(0)}*cos({_turn(0)})/cos(radians(dec_deg))")} AS ra_deg, {r6(f"dec_deg+a*{_draw(0)}*sin({_turn(0)})")} AS dec_deg, {r6(f"mag+p*{_draw(1)}*cos({_turn(1)})")} AS mag, {r6("a")} AS ra_sigma_deg, {r6("p")} AS mag_sigma
FROM (SELECT *, CASE WHEN s2n<=15e-1 THEN 15e-1 ELSE 7e-2*(5/s2n) END/36e2 AS a, -25e-1*log10(1-1/greatest(s2n, 15e-1)) AS p, md5('7/0/' || CAST(det_id AS VARCHAR)) AS h0, md5('7/1/' || CAST(det_id AS VARCHAR)) AS h1 FROM detections) x""")
R.add("p17_astrometry_policy", lambda v: v.detections.select("det_id", ph.apply_astrometry_policy(C("mag_sigma"), 0.03, 0.1).alias("s"), ph.apply_astrometry_policy(C("mag_sigma"), 0.03, 0.1, 0.02).alias("f")).transform(rounded, "s"), f"SELECT det_id, {r6('least(1e-1, sqrt(9e-4+mag_sigma*mag_sigma))')} AS s, 2e-2 AS f FROM detections")
R.add("p18_trail_columns", lambda v: ph.resolve_trail_columns(v.detections.select("det_id", F.when(C("det_id") % 3 == 0, 0x20000001).otherwise(1).cast("bigint").alias("flags"), C("ra_deg").alias("psf_ra"), (C("ra_deg") + 0.001).alias("ext_ra"), C("dec_deg").alias("psf_dec"), (C("dec_deg") + 0.002).alias("ext_dec"), C("mag").alias("psf_mag"), (C("mag") - 0.1).alias("ext_mag"), (C("s2n") / 20).alias("ext_theta"), C("s2n").alias("ext_major_px")), 0.25).select("det_id", "ra_deg", "dec_deg", "mag", "orient_deg", "length_deg").transform(rounded, "ra_deg", "dec_deg", "mag", "orient_deg", "length_deg"), f"""
WITH a AS (SELECT det_id, det_id%3=0 AS x, CASE WHEN det_id%3=0 THEN ra_deg+1e-3 ELSE ra_deg END AS ra, CASE WHEN det_id%3=0 THEN dec_deg+2e-3 ELSE dec_deg END AS dec, CASE WHEN det_id%3=0 THEN mag-1e-1 ELSE mag END AS m, degrees(s2n/20)+90 AS o, s2n*25e-2/3600 AS l FROM detections)
SELECT det_id, {r6("ra-360e0*floor(ra/360e0)")} AS ra_deg, {r6("dec")} AS dec_deg, {r6("m")} AS mag, {r6("CASE WHEN x THEN o-360e0*floor(o/360e0) ELSE 0e0 END")} AS orient_deg, {r6("CASE WHEN x THEN l ELSE 0e0 END")} AS length_deg FROM a""")
R.add("p19_trail_length", lambda v: v.detections.select("det_id", ph.normalize_trail_length(C("s2n") / 1000, F.lit(45.0)).alias("l")).transform(rounded, "l"), f"SELECT det_id, {r6('s2n/1000*30e0/45e0')} AS l FROM detections")


def _axes(v):
    a, b, t = ph.morphology_axes(C("s2n") / 5 + 2, (C("det_id") % 7) / 5.0, C("mag") / 9)
    return rounded(v.detections.select("det_id", a.alias("major"), b.alias("minor"), t.alias("angle")), "major", "minor", "angle")


R.add("p20_morphology_axes", _axes, f"""
WITH a AS (SELECT det_id, s2n/5+2 AS xx, (det_id%7)/5e0 AS xy, mag/9 AS yy FROM detections), b AS (SELECT *, (xx+yy)/2 AS m, sqrt(pow((xx-yy)/2,2)+pow(xy,2)) AS h FROM a)
SELECT det_id, {r6("sqrt(m+h)")} AS major, {r6("sqrt(greatest(0e0,m-h))")} AS minor, {r6("degrees(atan2(2*xy,xx-yy)/2)")} AS angle FROM b""")
_class = """CASE WHEN e>0 AND e<1 THEN CASE WHEN coalesce(moid_1<5e-2,false) OR coalesce(moid_2<5e-2,false) THEN 'PHO' WHEN q<13e-1 THEN 'NEO' WHEN q>13e-1 AND q<=167e-2 THEN 'MC' WHEN a>167e-2 AND a<=5 THEN 'MB' WHEN a>5 AND a<=55e-1 THEN 'TRO' WHEN a>5 AND a<=35 THEN 'CEN' WHEN a>35 AND a<=50 THEN 'TNO' WHEN a>50 THEN 'SDO'
WHEN t>2 AND t<3 THEN 'SPC' WHEN t<2 AND a<=342e-1 THEN 'HFC' WHEN t<2 AND a>342e-1 THEN 'LPC' ELSE 'UNK' END WHEN e>1 THEN 'HYP' ELSE 'UNK' END"""
_orb = "(SELECT *, 52e-1/a+2*sqrt((1-e*e)*a/52e-1)*cos(radians(i)) AS t FROM (SELECT *, q/(1-e) AS a FROM ssm) y)"
R.add("p21_classify_orbits", lambda v: o.classify_orbits(v.ssm).select("ssm_id", "dyn_class"), f"SELECT ssm_id, {_class} AS dyn_class FROM {_orb} x")
R.add("p22_valid_orbit", lambda v: v.ssm.select("ssm_id", o.valid_orbit(C("q") - 1.0, C("e"), C("i"), C("node"), C("arg_peri") + 10).alias("ok")), "SELECT ssm_id, NOT (q-1 <= 0 OR e<0 OR i>180 OR i<0 OR node<0 OR node>360 OR arg_peri+10<0 OR arg_peri+10>360 OR (e>10 AND e/q>1e7)) AS ok FROM ssm")


def _d(v):
    names = ("q", "e", "i", "node", "arg_peri")
    a = v.ssm.select("ssm_id", *[C(n).alias(f"a_{n}") for n in names])
    b = v.ssm.select((C("ssm_id") - 1).alias("ssm_id"), *[C(n).alias(f"b_{n}") for n in names])
    d3, d4 = o.d_criterion({n: C(f"a_{n}") for n in names}, {n: C(f"b_{n}") for n in names})
    return rounded(a.join(b, "ssm_id").select("ssm_id", d3.alias("d3"), d4.alias("d4")), "d3", "d4")


R.add("p23_d_criterion", _d, f"""
WITH a AS (SELECT a.ssm_id, a.q AS q1, b.q AS q2, a.e AS e1, b.e AS e2, radians(a.i) AS i1, radians(b.i) AS i2, radians(a.node) AS n1, radians(b.node) AS n2, radians(a.arg_peri-b.arg_peri) AS w FROM ssm a JOIN ssm b ON b.ssm_id=a.ssm_id+1),
b AS (SELECT *, acos(greatest(-1e0,least(1e0,cos(i1)*cos(i2)+sin(i1)*sin(i2)*cos(n1-n2)))) AS m FROM a), c AS (SELECT *, w+2*asin(greatest(-1e0,least(1e0,cos((i1+i2)/2)*sin((n1-n2)/2)/cos(m/2)))) AS t, pow(q1-q2,2)+pow(e1-e2,2)+pow(2*sin(m/2),2) AS x FROM b)
SELECT ssm_id, {r6("sqrt(x)")} AS d3, {r6("sqrt(x+pow((e1+e2)*sin(t/2),2))")} AS d4 FROM c""")
_b62 = "'0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ'"
R.add("p24_assign_names", lambda v: o.assign_names(v.ssm.select("ssm_id"), "L0000", ["ssm_id"], 100).select("ssm_id", "name", o.from_base62(F.substring("name", 2, 4)).alias("number")), "SELECT ssm_id, 'L' || " + " || ".join(f"substr({_b62}, CAST(floor(k/{62**p}e0) AS BIGINT) % 62 + 1, 1)" for p in (3, 2, 1, 0)) + " AS name, k AS number FROM (SELECT ssm_id, 99 + row_number() OVER (ORDER BY ssm_id) AS k FROM ssm) x")
R.add("p25_survey_mode", lambda v: v.fields.select("field_id", o.normalize_survey_mode(F.concat(F.lower("survey_mode"), F.lit(".x"), C("p"))).alias("mode")), "SELECT field_id, survey_mode AS mode FROM fields")
R.add("p26_object_family", lambda v: v.ssm.groupBy(o.object_family(C("object_name")).alias("family")).agg(F.count("*").alias("n")), "SELECT substr(object_name,1,2) AS family, count(*) AS n FROM ssm GROUP BY 1")

# Selections.
D = "det_id, field_id, mag, s2n, status"
R.add("f1_select_detections", lambda v: s.select_detections(v.detections, min_s2n=20.0, nn=55004, fields=v.fields).select(*D.split(", ")), f"SELECT {D} FROM detections WHERE status='F' AND s2n>=20 AND nn=55004")
R.add("f2_detections_by_tracklet_status", lambda v: s.detections_by_tracklet_status(v.movers, v.tracklet_attrib, v.tracklets, "A", nn=[55003, 55006]).select("det_id", "nn"), "SELECT det_id, nn FROM movers WHERE det_id IN (SELECT det_id FROM tracklet_attrib a JOIN tracklets t ON t.tracklet_id=a.tracklet_id WHERE t.status='A' AND t.nn IN (55003,55006))")
R.add("f3_detections_of_object", lambda v: s.detections_of_object(v.movers, v.tracklet_attrib, v.derivedobject_attrib, [10, 20, 31]).select("derivedobject_id", "tracklet_id", "det_id", "mag"), "SELECT m.derivedobject_id, m.tracklet_id, d.det_id, d.mag FROM derivedobject_attrib m JOIN tracklet_attrib a ON a.tracklet_id=m.tracklet_id JOIN movers d ON d.det_id=a.det_id WHERE m.derivedobject_id IN (10,20,31)")
R.add("f4_select_fields", lambda v: s.select_fields(v.fields, ocnum=None, mjd=(55003.0, 55009.0), status=["N", "D"], parents_only=True).select("field_id", "epoch_mjd", "status"), "SELECT field_id, epoch_mjd, status FROM fields WHERE epoch_mjd>=55003 AND epoch_mjd<55009 AND status IN ('N','D') AND parent_id IS NULL")
for m, sql_ in (("oldest", "WHERE status IN ('N','D','T','U','A') ORDER BY epoch_mjd, field_id"), ("first", "WHERE status IN ('N','D','T','U','A') ORDER BY CASE status WHEN 'N' THEN 1 WHEN 'D' THEN 2 WHEN 'T' THEN 3 WHEN 'U' THEN 4 ELSE 5 END, epoch_mjd, field_id"), ("last", "WHERE status='L' ORDER BY epoch_mjd DESC, field_id DESC")):
    R.add(f"f5_next_field_{m}", lambda v, m=m: s.next_field(v.fields, m).select("field_id", "status"), f"SELECT field_id, status FROM fields {sql_} LIMIT 1")
R.add("f6_select_tracklets", lambda v: s.select_tracklets(v.tracklets, v.tracklet_attrib, v.derivedobject_attrib, status=["U", "A"], derivedobject_id=v.derivedobjects.filter("status = 'M'"), mjd=(55001.0, 55020.0)).select("tracklet_id", "status"), "SELECT tracklet_id, status FROM tracklets WHERE status IN ('U','A') AND ext_epoch>=55001 AND ext_epoch<55020 AND tracklet_id IN (SELECT tracklet_id FROM derivedobject_attrib m JOIN derivedobjects o ON o.derivedobject_id=m.derivedobject_id WHERE o.status='M')")
R.add("f7_tracklets_in_field", lambda v: s.tracklets_in_field(v.tracklets, v.tracklet_attrib, v.movers, v.fields.filter("status = 'N'"), (0.5, 1.5), True), "SELECT t.tracklet_id FROM tracklet_attrib a JOIN movers d ON d.det_id=a.det_id JOIN tracklets t ON t.tracklet_id=a.tracklet_id JOIN fields f ON f.field_id=d.field_id WHERE f.status='N' AND vel_tot BETWEEN 5e-1 AND 15e-1")
R.add("f8_select_detracklets", lambda v: s.select_detracklets(v.tracklets, v.tracklet_attrib, v.movers, probability=0.5, speed=(0.2, 1.0)).select("tracklet_id", "det_id", "probability", "vel_tot", "mag"), "SELECT t.tracklet_id, d.det_id, probability, vel_tot, mag FROM tracklets t JOIN tracklet_attrib a ON a.tracklet_id=t.tracklet_id JOIN movers d ON d.det_id=a.det_id WHERE probability>=5e-1 AND vel_tot BETWEEN 2e-1 AND 1e0")
R.add("f9_select_objects", lambda v: s.select_objects(v.derivedobjects, v.derivedobject_attrib, v.ssm, updated_since=55010, orbit=C("q") < 1.3).select("derivedobject_id", "q", "status"), "SELECT derivedobject_id, q, o.status FROM derivedobjects o JOIN ssm s ON s.orbit_id=o.orbit_id WHERE updated_nn>=55010 AND q<13e-1")
for m, cond in (("unmerged", "true"), ("updated", "updated_nn>=55015"), ("queue", "derivedobject_id IN (SELECT derivedobject_id FROM eon_queue WHERE status='I')"), ("data", "derivedobject_id NOT IN (SELECT derivedobject_id FROM eon_queue WHERE status='I')"), ("moid", "q-3*coalesce(q_sigma,0e0)<13e-1")):
    R.add(f"f10_select_orbits_{m}", lambda v, m=m: s.select_orbits(v.derivedobjects, v.ssm, v.eon_queue, m, 55015).select("derivedobject_id", "q"), f"SELECT derivedobject_id, q FROM derivedobjects o JOIN ssm s ON s.orbit_id=o.orbit_id WHERE o.status<>'M' AND {cond}")
R.add("f11_select_population", lambda v: s.select_population(v.ssm, (20, 1500), predicate=C("h_v") < 15).select("ssm_id", "h_v"), "SELECT ssm_id, h_v FROM ssm WHERE ssm_id BETWEEN 20 AND 1500 AND h_v < 15")
R.add("f12_select_history", lambda v: s.select_history(v.history.select("event_id", "event_type", "derivedobject_id", "field_id"), {"A": v.history.select("event_id", "ephemeris_distance"), "D": v.history.select("event_id", "orbit_code")}, derivedobject_id=v.derivedobjects.filter("classification = 'C'")), "SELECT event_id, event_type, derivedobject_id, field_id, CASE WHEN event_type='A' THEN ephemeris_distance END AS ephemeris_distance, CASE WHEN event_type='D' THEN orbit_code END AS orbit_code FROM history WHERE derivedobject_id IN (SELECT derivedobject_id FROM derivedobjects WHERE classification='C')")


def _ingest(v):
    d = v.detections.withColumns({"flags": (C("det_id") % 8).cast("bigint"), "moment": (C("det_id") % 11).cast("double"), "dist": (C("det_id") % 40).cast("double"), "bm": F.lit(12.0) + C("det_id") % 5, "ps": C("s2n") * (C("det_id") % 9), "ns": C("s2n") * (C("det_id") % 12)})
    codes = [c.silly_code(C("flags"), C("mag"), C("mag_sigma"), C("moment")), c.bright_code(C("dist"), C("bm"), 5, 14.0), c.low_s2n_code(C("mag_sigma"), 8.0), c.dipole_code(C("flags"), C("s2n"), C("ps"), C("ns"), 4)]
    return d.select("det_id", *[x.alias(n) for x, n in zip(codes, ("f13", "f14", "f15", "f16"), strict=True)]), c.clean_ingest(d, codes).select("det_id", "status")


_codes = "CASE WHEN det_id%2=1 OR mag_sigma<=0 OR mag<0 OR mag>30 OR det_id%11=0 THEN 'S' END AS f13, CASE WHEN det_id%40<5 AND 12+det_id%5<14 THEN 'B' END AS f14, CASE WHEN 25e-1/ln(10e0)/mag_sigma<8 THEN 'L' END AS f15, CASE WHEN det_id%8>=4 AND s2n*(det_id%9)>5*s2n AND s2n*(det_id%12)>5*s2n THEN 'D' END AS f16"
R.add("f13_f16_ingest_codes", lambda v: _ingest(v)[0], f"SELECT det_id, {_codes} FROM detections")
R.add("f17_clean_ingest", lambda v: _ingest(v)[1], f"SELECT det_id, coalesce(f13,f14,f15,f16,'F') AS status FROM (SELECT det_id, {_codes} FROM detections) x")
R.add("f18_time_brightness", lambda v: c.brightness_filter(c.time_filter(v.detections, 55003.2, 55010.7), -1, 20.05).select("det_id"), "SELECT det_id FROM detections WHERE epoch_mjd>=550032e-1 AND epoch_mjd<=550107e-1 AND mag<=2005e-2")
R.add("f19_box_region", lambda v: c.box_filter(v.detections, 350.0, 80.0, -40.0, 35.0).select("det_id").union(c.region_filter(v.detections, 37.0, 17.0, 60.0).select("det_id")), f"SELECT det_id FROM detections WHERE (ra_deg>=350 OR ra_deg<=80) AND dec_deg BETWEEN -40 AND 35 UNION ALL SELECT det_id FROM detections WHERE {sep('37e0', '17e0', 'ra_deg', 'dec_deg')} <= 60")
R.add("f20_visible_predictions", lambda v: s.visible_predictions(v.predictions, 20.05), "SELECT object_id, min(mag) AS brightest FROM predictions GROUP BY 1 HAVING min(mag) < 2005e-2")
R.add("f21_detectable", lambda v: s.detectable(v.predictions, v.fields, 5.0, True).union(s.detectable(v.predictions, v.fields, None)), f"""
WITH j AS (SELECT p.*, f.ra_deg AS fr, f.dec_deg AS fd, f.limiting_mag AS lm, sin(radians(f.dec_deg))*sin(radians(p.dec_deg))+cos(radians(f.dec_deg))*cos(radians(p.dec_deg))*cos(radians(p.ra_deg-f.ra_deg)) AS dp FROM predictions p JOIN fields f ON f.field_id=p.field_id)
SELECT object_id, field_id FROM j WHERE dp>0 AND abs(cos(radians(dec_deg))*sin(radians(ra_deg-fr))/dp)<radians(3e0)/2 AND abs((cos(radians(fd))*sin(radians(dec_deg))-sin(radians(fd))*cos(radians(dec_deg))*cos(radians(ra_deg-fr)))/dp)<radians(3e0)/2 AND {_s.format(z="462e-1", d="", t="30e0", w="6e-1")} >= 5
UNION ALL SELECT object_id, field_id FROM j WHERE {sep("fr", "fd", "ra_deg", "dec_deg")} < 15e-1 AND mag<=lm""")
R.add("f22_select_extended", lambda v: s.select_extended(v.detections.select("det_id"), v.detections.select("det_id", (C("s2n") / 5).alias("xx"), F.lit(0.5).alias("xy"), (C("mag") / 9).alias("yy")), 3.0).transform(rounded, "major_px"), f"SELECT det_id, {r6('m')} AS major_px FROM (SELECT det_id, sqrt((s2n/5+mag/9)/2+sqrt(pow((s2n/5-mag/9)/2,2)+25e-2)) AS m FROM detections) x WHERE m > 3")
R.add("s12_sample_every", lambda v: s.sample_every(v.ssm.select("ssm_id"), 7, 3, "ssm_id"), "SELECT ssm_id FROM (SELECT ssm_id, row_number() OVER (ORDER BY ssm_id) - 1 AS k FROM ssm) x WHERE (k - 3) % 7 = 0")
R.add("s12_interleave", lambda v: s.interleave(v.ssm.select("ssm_id"), 5, "ssm_id"), "SELECT ssm_id, CAST((row_number() OVER (ORDER BY ssm_id) - 1) % 5 AS INT) AS part FROM ssm")
