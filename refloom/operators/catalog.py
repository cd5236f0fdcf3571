"""Catalog matching (X3): dedupe records across ordered queries (U5), score and pick
the best dataset (F4, O3), filter a dataset's resources to a year's reference
tables (P10, O4), name their files (F6) and reject resources without a URL (F7).

Catalog rows: ``(id, slug, page, title, description, query_pos, item_pos,
n_resources)``; resource rows: ``(dataset_id, pos, title, url, format, …)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.functions.text import DATASET_TERMS, concat_truthy, first_truthy, fold, keyword_score, safe_file_name
from refloom.operators.order import ordered_places
from refloom.session import cut_lineage

#: Datasets whose first places may be broadcast; more are joined by shuffle.
BROADCAST_KEYS = 200_000

# What a reference-table resource mentions (besides the year).
RESOURCE_TERMS = ("table", "refer")
RESOURCE_FIELDS = ("title", "description", "type", "format", "mime", "url", "latest")
DATASET_FIELDS = ("title", "description", "slug", "page")


def _opt(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def dataset_key(df: DataFrame):
    """first non-empty of id, slug, page, else ''."""
    return first_truthy(_opt(df, "id"), _opt(df, "slug"), _opt(df, "page"), default="")


def dedupe_datasets(df: DataFrame, order: Sequence[str] = ("query_pos", "item_pos")) -> DataFrame:
    """First-seen record per key across ordered queries.

    The first place per key is an aggregate over the key and the order alone, so neither
    texts nor whole records are sorted or shuffled; the records are then filtered out in
    place by a semi join on (key, place), broadcast where the keys are few. Records without
    any id all share the key '', which may be a large part of the input: one row per key and
    task leaves for the shuffle. Unknown (null) places come last. Records that share both key
    and place are one record read twice; one of them stays.
    """
    keyed = df.withColumn("dataset_key", dataset_key(df))
    place = F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(c))])
    firsts = cut_lineage(keyed.groupBy("dataset_key").agg(F.min(place).alias("_first")).select("dataset_key", *[f"_first.{c}" for c in order]))
    few = firsts.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    same = reduce(and_, [F.col(f"r.`{c}`").eqNullSafe(F.col(f"f.`{c}`")) for c in ["dataset_key", *order]])
    found = keyed.alias("r").join((F.broadcast(firsts) if few else firsts).alias("f"), same, "left_semi")
    return found.dropDuplicates(["dataset_key"]).select("dataset_key", *df.columns)


def score_datasets(df: DataFrame) -> DataFrame:
    """keyword score over folded title+description+slug+page; resource count."""
    text = fold(concat_truthy(*[_opt(df, c) for c in DATASET_FIELDS]))
    return df.withColumn("score", keyword_score(text, DATASET_TERMS))


def best_dataset(scored: DataFrame, order: Sequence[str] = ("query_pos", "item_pos")) -> DataFrame:
    """O3: the best-scored dataset, then most resources, then first seen; only if its
    score is positive. A top-1 (per-task top-1, then merge), not a global sort."""
    ranked = scored.orderBy(F.desc("score"), F.desc("n_resources"), *[F.asc(c) for c in order]).limit(1)
    return ranked.filter(F.col("score") > 0)


def matching_resources(resources: DataFrame, year: int) -> DataFrame:
    """P10: resources whose folded text (7 fields) contains the year, ``table`` and ``refer``.

    Order by title (missing as '') then position with ``orderBy`` when a listing is
    needed (O4); the filter itself keeps every matching row.
    """
    return resources.filter(_is_reference_table(resources, year))


def _is_reference_table(resources: DataFrame, year: int) -> Column:
    text = fold(concat_truthy(*[_opt(resources, c) for c in RESOURCE_FIELDS]))
    cond = text.contains(str(int(year)))
    for term in RESOURCE_TERMS:
        cond = cond & text.contains(term)
    return cond


def ordered_listing(resources: DataFrame, pos: str = "pos") -> DataFrame:
    """Order by title ('' when missing), then input position."""
    return resources.orderBy(F.coalesce(F.col("title"), F.lit("")), F.col(pos))


def listing_places(resources: DataFrame, pos: str = "pos") -> DataFrame:
    """O4 as a column: ``place`` of each resource in the whole ``ordered_listing``, from 1."""
    return ordered_places(resources, [F.coalesce(F.col("title"), F.lit("")), F.col(pos)], "place")


def with_file_names(resources: DataFrame) -> DataFrame:
    """``file_name`` for each resource."""
    r = resources
    return r.withColumn(
        "file_name",
        safe_file_name(_opt(r, "title"), _opt(r, "id"), _opt(r, "url"), _opt(r, "latest"), _opt(r, "format"), _opt(r, "type")),
    )


def split_missing_url(resources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resources with a URL, rejects with a reason naming the resource)."""
    url = first_truthy(_opt(resources, "url"), _opt(resources, "latest"))
    ok = resources.filter(url.isNotNull())
    name = first_truthy(_opt(resources, "title"), _opt(resources, "id"), default="<untitled>")
    rejects = resources.filter(url.isNull()).withColumn(
        "reason", F.concat(F.lit("resource '"), name, F.lit("' has no URL"))
    )
    return ok, rejects


def no_match_rejects(resources: DataFrame, year: int, dataset: str = "dataset_id") -> DataFrame:
    """P10's errors as data: datasets with resources of which none is a reference table of
    the year, one row each with a reason. An aggregate."""
    hit = _is_reference_table(resources, year).cast("int")
    found = resources.groupBy(dataset).agg(F.count(F.lit(1)).alias("n_resources"), F.max(hit).alias("_any"))
    return found.filter(F.col("_any") == 0).select(
        dataset, "n_resources", F.lit(f"no reference table of {int(year)}").alias("reason")
    )


def no_dataset_reject(scored: DataFrame) -> DataFrame:
    """O3's error as data: one row with a reason when no record scores above zero, else none."""
    best = scored.agg(F.count(F.lit(1)).alias("n_datasets"), F.max("score").alias("_best"))
    return best.filter(F.coalesce("_best", F.lit(0)) <= 0).select(
        "n_datasets", F.lit("no dataset mentions what is looked for").alias("reason")
    )


def reference_tables(datasets: DataFrame, resources: DataFrame, year: int, dataset_key: str = "slug",
                     resource_key: str = "dataset_id") -> DataFrame:
    """Best dataset (U5, F4, O3) -> its resources that are the year's reference
    tables (P10) -> file names (F6). The best dataset is one row (a proven bound), so
    it is broadcast to the resources."""
    best = best_dataset(score_datasets(dedupe_datasets(datasets))).select(F.col(dataset_key).alias("_key"))
    res = resources.join(F.broadcast(best), resources[resource_key] == F.col("_key"), "left_semi")
    return with_file_names(matching_resources(res, year))
