"""Declared schemas of the survey's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS: dict[str, str] = {
    "fields": "field_id bigint, epoch_mjd double, ra_deg double, dec_deg double, filter_id string, limiting_mag double, nn int, ocnum int, fov_deg double, status string, parent_id bigint, obscode string, survey_mode string",
    "detections": "det_id bigint, field_id bigint, ra_deg double, dec_deg double, epoch_mjd double, mag double, s2n double, ra_sigma_deg double, dec_sigma_deg double, mag_sigma double, length_deg double, orient_deg double, object_name string, status string, filter_id string, obscode string, xyidx int",
    "tracklets": "tracklet_id bigint, field_id bigint, vel_ra double, vel_dec double, vel_tot double, pos_ang double, gcr_arcsec double, ext_epoch double, ext_ra double, ext_dec double, probability double, digest double, status string, classification string, ssm_id bigint, known_id bigint",
    "tracklet_attrib": "tracklet_id bigint, det_id bigint",
    "derivedobjects": "derivedobject_id bigint, object_name string, orbit_id bigint, classification string, status string, ssm_id bigint, stable_pass string",
    "derivedobject_attrib": "derivedobject_id bigint, tracklet_id bigint",
    "orbits": "orbit_id bigint, q double, e double, i double, node double, arg_peri double, time_peri double, epoch double, h_v double, residual double, covariance array<double>, moid_1 double, moid_2 double, arc_length double, orbit_code string",
    "residuals": "det_id bigint, tracklet_id bigint, ra_resid double, dec_resid double, reject string",
    "ssm": "ssm_id bigint, orbit_id bigint, object_name string, h_v double",
    "history": "event_id bigint, event_type string, field_id bigint, derivedobject_id bigint, orbit_code string, classification string, ephemeris_distance double",
    "eon_queue": "queue_id bigint, derivedobject_id bigint, status string",
    "known": "known_id bigint, known_name string, orbit_id bigint",
    "deteff": "nn int, filter_id string, type string, mag_bin int, known bigint, found bigint",
    "alerts": "alert_id string, rule string, channel string, object_id bigint, status string",
    "ingest_status": "file_id string, size bigint, status string",
}


def load_tables(spark: SparkSession, folder: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The survey's tables below a folder, each with its declared schema (missing columns are null)."""
    return {n: spark.read.schema(SCHEMAS[n]).parquet(f"{folder}/{n}") for n in (names or SCHEMAS)}
