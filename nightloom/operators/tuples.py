"""Grouping exposures into tuples, and marking parents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.orbits import normalize_survey_mode


TUPLE_FIELDS = "kind string, tuple_id bigint, place int"


def assemble_tuples(fields: DataFrame, min_fields: int, max_fields: int, min_minutes: float, max_minutes: float, max_separation: float = 0.1, any_filter: bool = False, max_deep: int = 8, deep_stacks: bool = True, by: str = "nn", within: tuple[str, ...] = ()) -> DataFrame:
    """(field_id, kind, tuple_id, place): exposures of one pointing grouped in time order.

    From each exposure the later ones of the same filter (unless ``any_filter``) and place join while the gap to the last one is between
    the limits (kind TTI), or shorter than them (DEEP). Groups of fewer than ``min_fields`` are orphans. ``tuple_id`` is the last
    exposure. The order-dependent choice runs inside one night, ``within`` (such as a survey's footprint cells, whose exposures belong together) and filter. Rows
    pass sorted by these, so a task holds one such group and a batch, however many there are.
    """
    chord = 2 * np.sin(np.radians(min(max_separation, 180.0)) / 2)
    reach = 1.001 * np.radians(max_separation)

    def group(ids: list, epochs: np.ndarray, ra: np.ndarray, dec: np.ndarray) -> list[tuple]:
        minutes = (epochs * 1440).tolist()
        ra, dec = np.radians(ra), np.radians(dec)
        xyz = np.stack([np.cos(dec) * np.cos(ra), np.cos(dec) * np.sin(ra), np.sin(dec)], axis=1)
        by_dec = np.argsort(dec, kind="stable")
        sorted_dec = dec[by_dec]
        free = np.ones(len(ids), bool)
        out = []
        for first in range(len(ids)):
            if not free[first]:
                continue
            free[first] = False
            band = by_dec[np.searchsorted(sorted_dec, dec[first] - reach) : np.searchsorted(sorted_dec, dec[first] + reach, "right")]
            near = np.sort(band[free[band] & (band > first)])
            near = near[np.sqrt(((xyz[near] - xyz[first]) ** 2).sum(axis=1)) < chord]
            kind, chosen = "ORPHAN", [first]
            for k in near.tolist():
                gap = minutes[k] - minutes[chosen[-1]]
                if min_minutes < gap < max_minutes:
                    kind, most = "TTI", max_fields
                elif gap < min_minutes and deep_stacks:
                    kind, most = "DEEP", max_deep
                else:
                    continue
                free[k] = False
                chosen.append(k)
                if len(chosen) == most:
                    break
            if kind == "ORPHAN" or len(chosen) < min_fields:
                out += [(ids[f], "ORPHAN", None, 0) for f in chosen]
            else:
                out += [(ids[f], kind, ids[chosen[-1]], n) for n, f in enumerate(chosen)]
        return out

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the rows so far of the group that the last batch ended in

        def grouped(pdf: pd.DataFrame) -> pd.DataFrame:
            ids, epochs, ra, dec = pdf["field_id"].tolist(), pdf["epoch_mjd"].to_numpy(), pdf["ra_deg"].to_numpy(), pdf["dec_deg"].to_numpy()
            key = pdf["_g"].to_numpy()
            edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(ids)]
            out = [row for a, z in zip(edges[:-1], edges[1:], strict=True) for row in group(ids[a:z], epochs[a:z], ra[a:z], dec[a:z])]
            return pd.DataFrame(out, columns=["field_id", "kind", "tuple_id", "place"]).astype({"tuple_id": "Int64"})

        for pdf in batches:
            if pdf.empty:
                continue
            key = pdf["_g"].to_numpy()
            if held and held[0]["_g"].iloc[0] == key[-1]:
                held.append(pdf)
                continue
            start = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
            whole = [*held, pdf.iloc[:start]]
            held = [pdf.iloc[start:]]
            if sum(map(len, whole)):
                yield grouped(pd.concat(whole, ignore_index=True))
        if held:
            yield grouped(pd.concat(held, ignore_index=True))

    keys = list(dict.fromkeys([by, *within, *([] if any_filter else ["filter_id"])]))
    named = F.to_json(F.struct(*[F.col(k) for k in keys]), {"ignoreNullFields": "false"}).alias("_g")
    rows = fields.select(named, "field_id", "epoch_mjd", "ra_deg", "dec_deg")
    return rows.repartition("_g").sortWithinPartitions("_g", "epoch_mjd", "field_id").mapInPandas(walk, f"field_id bigint, {TUPLE_FIELDS}")


def assemble_stacks(fields: DataFrame, min_minutes: float, max_minutes: float, max_separation: float = 0.4, any_filter: bool = True, within: tuple[str, ...] = ()) -> DataFrame:
    """The stage's variant: per night and normalised survey mode, any filter but w together, classed by size (PAIR, TRIPLE, TUPLE, ORPHAN)."""
    mode = F.concat_ws("/", F.col("nn").cast("string"), normalize_survey_mode(F.col("survey_mode")), F.when(F.col("filter_id") == "w", "w").otherwise("any") if any_filter else F.col("filter_id"))
    tuples = assemble_tuples(fields.withColumn("_by", mode), 2, 8, min_minutes, max_minutes, max_separation, True, deep_stacks=False, by="_by", within=within)
    size = tuples.filter("kind <> 'ORPHAN'").groupBy("tuple_id").agg(F.count("*").alias("n"))
    joined = tuples.join(size, "tuple_id", "left")
    return joined.select("field_id", "tuple_id", "place", F.when(F.col("n") == 2, "PAIR").when(F.col("n") == 3, "TRIPLE").when(F.col("n") > 3, "TUPLE").otherwise("ORPHAN").alias("kind"))


def find_pairs(pointings: DataFrame, low_minutes: float, high_minutes: float, cell: str = "p") -> DataFrame:
    """(field_id, pair_id): consecutive exposures of a footprint, night and filter within gap limits, each used once.

    Runs of qualifying gaps are cut in twos by the parity of a row's place in its run.
    """
    w = W.partitionBy(cell, "nn", "filter_id").orderBy("epoch_mjd", "field_id")
    gap = (F.col("epoch_mjd") - F.lag("epoch_mjd").over(w)) * 1440
    g = pointings.withColumn("_ok", F.coalesce(gap.between(low_minutes, high_minutes), F.lit(False)).cast("int")).withColumn("_prev", F.lag("field_id").over(w))
    run = g.withColumn("_run", F.sum(1 - F.col("_ok")).over(w))
    placed = run.withColumn("_place", F.row_number().over(W.partitionBy(cell, "nn", "filter_id", "_run").orderBy("epoch_mjd", "field_id")))
    return placed.filter("_place % 2 = 0").select(F.col("_prev").alias("first_field"), F.col("field_id").alias("second_field"))


def mark_parents(fields: DataFrame, tuples: DataFrame) -> DataFrame:
    """Fields with ``new_parent`` (the last of their tuple, null for it) and ``conflict`` where they had another one."""
    last = tuples.filter("tuple_id is not null").select("field_id", "tuple_id")
    j = fields.join(last, "field_id", "left")
    new = F.when(F.col("tuple_id") != F.col("field_id"), F.col("tuple_id"))
    return j.select("field_id", F.coalesce(new, F.col("parent_id")).alias("new_parent"), (F.col("parent_id").isNotNull() & new.isNotNull() & (F.col("parent_id") != new)).alias("conflict"))


def expand_tuples(fields: DataFrame, parents: DataFrame) -> DataFrame:
    """(parent_id, field_ids): all fields of the given parents' tuples."""
    member = fields.select(F.coalesce("parent_id", "field_id").alias("parent_id"), "field_id")
    return member.join(parents.select("parent_id"), "parent_id", "left_semi").groupBy("parent_id").agg(F.array_sort(F.collect_list("field_id")).alias("field_ids"))


def tag_orphans(fields: DataFrame, tuples: DataFrame, done: str = "L") -> DataFrame:
    """``fields`` with the status of those that no tuple took (``kind`` ORPHAN of :func:`assemble_tuples`) set to ``done``: nothing waits for them to be linked."""
    orphans = tuples.filter("kind = 'ORPHAN'").select("field_id", F.lit(done).alias("_done")).distinct()
    return fields.join(orphans, "field_id", "left").withColumn("status", F.coalesce("_done", "status")).select(*fields.columns)
