"""Totals, months per title and per skill over item tables, and run statistics.

Tables hold one row per job ``(source_url, item_no, title, months, duties, ...)``
and one row per known skill ``(source_url, skill_no, skill)``. Every job sums on
the map side before its exchange, so a profile with very many rows arrives as a
few partial rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossierflow.functions import dates as D
from dossierflow.functions import experience as X
from dossierflow.functions import similarity as M
from dossierflow.functions import skills as S
from dossierflow.functions import text as T
from dossierflow.functions import vocabulary as V
from dossierflow.operators.common import explode_rows
from dossierflow.operators.similarity import BROADCAST_BYTES, fits_broadcast, unit_vectors

KEYS = ("source_url",)
SKILLS_PER_ROW = 256


def totals(
    items: DataFrame, *, keys: tuple[str, ...] = KEYS, months: str = "months",
    out: str = "work",
) -> DataFrame:
    """``(*keys, total_<out>_months, total_<out>_years)``; overlapping jobs count twice."""
    total = F.sum(F.coalesce(F.col(months), F.lit(0))).cast("bigint")
    summed = items.groupBy(*keys).agg(total.alias(f"total_{out}_months"))
    return summed.withColumn(f"total_{out}_years", D.years_1dp(F.col(f"total_{out}_months")))


def _titled(items: DataFrame, keys) -> DataFrame:
    named = items.select(
        *keys, "item_no", T.strip(F.col("title")).alias("title"), F.col("months"),
    ).filter(F.col("months") > 0)
    return named.withColumn("position", X.title_key(F.col("title"))).filter(F.col("position") != "")


def months_by_title(items: DataFrame, *, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Months per normalised title of a profile:
    ``(*keys, position, display_position, months, years, titles, first_item_no)``.

    ``titles`` are the first 20 spellings in order. Order a profile's rows by
    months descending, then ``first_item_no``.
    """
    group = [*keys, "position"]
    # one row per spelling first: cheap partial sums whatever the group size
    spellings = _titled(items, keys).groupBy(*group, "title").agg(
        F.sum("months").alias("months"), F.min("item_no").alias("item_no")
    )
    place = F.row_number().over(Window.partitionBy(*group).orderBy("title"))
    kept = F.when(F.col("place") <= V.TITLES_KEPT, F.col("title"))
    grouped = spellings.withColumn("place", place).groupBy(*group).agg(
        F.min_by("title", "item_no").alias("display_position"),
        F.sum("months").cast("int").alias("months"),
        F.array_sort(F.collect_list(kept)).alias("titles"),
        F.min("item_no").alias("first_item_no"),
    )
    return grouped.select(
        *group, "display_position", "months", D.years_1dp(F.col("months")).alias("years"),
        "titles", "first_item_no",
    )


def months_by_title_similar(
    items: DataFrame, vectors: DataFrame | None = None, *, thr: float = V.TITLE_SIMILARITY,
    fn: Callable[[np.ndarray, np.ndarray], np.ndarray] = M.dot_rows,
    keys: tuple[str, ...] = KEYS, vector: str = "vector", max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Months per cluster of similar titles, in item order.

    A title joins the most similar cluster representative if the similarity
    reaches ``thr``, else it starts a cluster; a shorter title replaces the
    representative. ``vectors`` is ``(title, vector)``; leave it out when
    ``items`` has the vector column. ``fn(vector, matrix)`` gives similarities
    to all representatives.

    Each decision depends on the ones before it within a profile, so a profile
    is read in order. Rows stream through sorted partitions: only the cluster
    representatives of the current profile are held, never its item list. A table
    of vectors below ``max_broadcast_bytes`` (its size is measured) goes to the tasks as it is,
    and rows move without them.
    """
    sent = None
    if vectors is not None:
        # one row per text, so that a vector listed twice doesn't double its months
        lookup = unit_vectors(vectors, "title")
        if fits_broadcast(lookup, max_broadcast_bytes):
            listed = lookup.where(F.col("_text").isNotNull() & F.col("_v").isNotNull()).collect()  # bounded
            sent = items.sparkSession.sparkContext.broadcast({r["_text"]: np.array(r["_v"], dtype=np.float64) for r in listed})
            titled = _titled_with(items, None, keys, None)
        else:
            titled = _titled_with(items, lookup, keys, None)
    else:
        titled = _titled_with(items, None, keys, vector)
    ordered = titled.repartition(*keys).sortWithinPartitions(*keys, "item_no")
    schema = ", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in titled.select(*keys).schema]
        + ["cluster_no int", "display_position string", "months bigint",
           "first_item_no bigint", "titles array<string>"]
    )
    found = ordered.mapInPandas(M.leader_clusters(list(keys), thr, fn, V.TITLES_KEPT, sent), schema)
    return found.select(
        *keys, "cluster_no", X.title_key(F.col("display_position")).alias("position"),
        "display_position", F.col("months").cast("int").alias("months"),
        D.years_1dp(F.col("months")).alias("years"), "titles", "first_item_no",
    )


def _titled_with(items: DataFrame, lookup: DataFrame | None, keys, vector: str | None) -> DataFrame:
    """Rows that count, with the vector of ``lookup`` or of the column ``vector``, or without one."""
    made = []
    if lookup is not None:
        items = items.withColumn("_text", T.strip(F.col("title"))).join(lookup, "_text", "left")
        made = [F.col("_v").alias("vector")]
    elif vector is not None:
        made = [M.unit(F.col(vector)).alias("vector")]
    usable = (F.col("months") > 0) & (X.title_key(F.col("title")) != "")
    return items.filter(usable).select(
        *keys, F.col("item_no").cast("bigint").alias("item_no"),
        T.strip(F.col("title")).alias("title"), F.col("months").cast("bigint").alias("months"), *made,
    )


def _duties(items: DataFrame, keys) -> DataFrame:
    """``(*keys, duty, months)``, one row per duty that is not blank."""
    rows = explode_rows(
        items.filter(F.col("months") > 0), [*keys, "months"], F.col("duties"), "duty", "duty_no"
    )
    return rows.select(*keys, T.strip(F.col("duty")).alias("duty"), "months").filter(F.col("duty") != "")


def _duty_months(items: DataFrame, keys) -> DataFrame:
    """Months per distinct duty text of a profile, summed before any join."""
    return _duties(items, keys).groupBy(*keys, "duty").agg(F.sum("months").alias("months"))


def _skills(skills: DataFrame, keys) -> DataFrame:
    named = skills.select(*keys, "skill_no", F.col("skill"), S.norm_skill(F.col("skill")).alias("name"))
    return named.filter(F.col("name") != "")


def skill_months(
    items: DataFrame, skills: DataFrame, *, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """``(*keys, skill, skill_months)``: every duty equal to a known skill of the
    profile adds the full months of its job, repeats included.

    Both sides are reduced to one row per (profile, text) before the equi-join,
    so the join is one-to-one and no pair list can grow.
    """
    duties = _duties(items, keys).groupBy(*keys, S.norm_skill(F.col("duty")).alias("name")).agg(
        F.sum("months").alias("months")
    )
    known = _skills(skills, keys).select(*keys, "name").distinct()
    matched = duties.join(known, [*keys, "name"])
    return matched.select(
        *keys, F.col("name").alias("skill"), F.col("months").cast("bigint").alias("skill_months")
    )


def skill_months_similar(
    items: DataFrame, skills: DataFrame, duty_vectors: DataFrame, skill_vectors: DataFrame, *,
    thr: float = V.SKILL_SIMILARITY, fn: Callable[[Column, Column], Column] = M.dot,
    keys: tuple[str, ...] = KEYS, max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """:func:`skill_months`, where a duty that equals no skill counts for the most
    similar known skill if the similarity reaches ``thr`` (ties: first skill).

    Vector tables are ``(duty, vector)`` and ``(skill, vector)``. A profile's
    skills travel as array rows of bounded length, so a duty meets them inside
    its own row and no duty-skill pairs are emitted. Vector tables that stay below
    ``max_broadcast_bytes`` (their size is measured) go to the tasks as two matrices, and rows
    carry the numbers of vectors; ``fn`` other than the dot product takes the vectors along.
    """
    duties = _duty_months(items, keys).withColumn("name", S.norm_skill(F.col("duty")))
    known = _skills(skills, keys)
    named = known.select(*keys, "name").distinct().withColumn("exact", F.lit(True))
    by_duty, by_skill = unit_vectors(duty_vectors, "duty"), unit_vectors(skill_vectors, "skill")
    if fn is M.dot and fits_broadcast(by_duty.unionByName(by_skill), max_broadcast_bytes):
        marked = duties.join(named, [*keys, "name"], "left")
        scored = _scored_by_number(marked, known, by_duty, by_skill, keys)
        return _matched(scored, thr, keys)
    embedded = known.join(by_skill.select(F.col("_text").alias("skill"), F.col("_v").alias("vector")), "skill")
    chunks = embedded.groupBy(*keys, F.floor(F.col("skill_no") / SKILLS_PER_ROW).alias("chunk")).agg(
        F.collect_list(F.struct("skill_no", "name", "vector")).alias("known")
    )
    vectors = by_duty.select(F.col("_text").alias("duty"), F.col("_v").alias("vector"))
    # one way for all duties: those that equal a skill are marked, and the others scored
    joined = duties.join(named, [*keys, "name"], "left").join(vectors, "duty", "left").join(chunks, list(keys), "left")
    best = F.array_max(
        F.transform(
            "known",
            lambda k: F.struct(
                fn(F.col("vector"), k.vector).alias("sim"), (-k.skill_no).alias("before"), k["name"].alias("name"),
            ),
        )
    )
    scored = joined.select(
        *keys, "duty", "name", "months", "exact",
        F.when(F.col("exact").isNull() & F.col("vector").isNotNull(), best).alias("best"),
    )
    return _matched(scored, thr, keys)


def _numbered(known: DataFrame, as_: str, no: str) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """``(as_, no)``, to be broadcast, with a matrix that has vector ``no`` as a column, and the lengths.
    What has no whole vector is like nothing and left out."""
    whole = F.col("_text").isNotNull() & (F.size("_v") > 0) & ~F.exists("_v", lambda x: x.isNull())
    rows = known.where(whole).select("_text", "_v").collect()  # bounded by max_broadcast_bytes
    lengths = np.array([len(r["_v"]) for r in rows], dtype=np.int64)
    matrix = np.zeros((lengths.max(initial=0), len(rows)))
    for i, r in enumerate(rows):
        matrix[: lengths[i], i] = r["_v"]
    numbers = known.sparkSession.createDataFrame([(r["_text"], i) for i, r in enumerate(rows)], f"{as_} string, {no} int")
    return F.broadcast(numbers), (matrix, lengths)


def _scored_by_number(marked: DataFrame, known: DataFrame, by_duty: DataFrame, by_skill: DataFrame, keys) -> DataFrame:
    """Duties with their best skill, found by the numbers of vectors that every task has."""
    duty_numbers, duty_matrix = _numbered(by_duty, "duty", "_own")
    skill_numbers, skill_matrix = _numbered(by_skill, "skill", "_no")
    sent = marked.sparkSession.sparkContext.broadcast((duty_matrix, skill_matrix))
    # the first of equal vectors is the skill that counts
    listed = F.struct((-F.col("skill_no")).alias("before"), F.col("name"), F.col("_no").alias("no"))
    chunks = known.join(skill_numbers, "skill").groupBy(
        *keys, F.floor(F.col("skill_no") / SKILLS_PER_ROW).alias("chunk")
    ).agg(F.sort_array(F.collect_list(listed), asc=False).alias("known"))
    joined = marked.join(duty_numbers, "duty", "left").join(chunks, list(keys), "left")
    asked = F.col("exact").isNull() & F.col("_own").isNotNull()
    best = F.pandas_udf(M.best_listed(sent), "sim double, at int")
    found = joined.withColumn("_best", best("_own", F.when(asked, F.transform("known", lambda k: k.no))))
    hit = F.get("known", F.col("_best.at"))
    return found.select(
        *keys, "duty", "name", "months", "exact",
        F.struct(F.col("_best.sim").alias("sim"), hit.before.alias("before"), hit["name"].alias("name")).alias("best"),
    )


def _matched(scored: DataFrame, thr: float, keys) -> DataFrame:
    # a profile's chunks of skills give a duty several rows
    found = scored.groupBy(*keys, "duty", "name").agg(
        F.max("best").alias("best"), F.max("months").alias("months"), F.max("exact").alias("exact")
    )
    similar = F.when((F.col("best.sim") >= thr) & (F.col("best.sim") > 0), F.col("best.name"))
    matched = found.select(*keys, F.when(F.col("exact"), F.col("name")).otherwise(similar).alias("skill"), "months")
    return matched.where(F.col("skill").isNotNull()).groupBy(*keys, "skill").agg(
        F.sum("months").cast("bigint").alias("skill_months")
    )


def run_stats(
    pages: DataFrame, links: DataFrame, payloads: DataFrame, *, page: str = "list_page",
) -> DataFrame:
    """One row: listing pages visited, URLs found, payloads made and failed, and
    payloads without their container. ``pages`` are the listing pages,
    ``links`` their links, ``payloads`` one row per tried URL with
    ``parse_mode`` and ``ok``."""
    parts = [
        pages.select(page).distinct().agg(F.count("*").alias("pages_visited")),
        links.agg(F.count("*").alias("urls_found")),
        payloads.agg(
            F.count_if(F.col("ok")).alias("payloads_yielded"),
            F.count_if(~F.col("ok")).alias("payloads_failed"),
            F.count_if(F.col("parse_mode") == V.MODE_WHOLE_PAGE).alias("missing_main_block"),
        ),
    ]
    one = parts[0].unionByName(parts[1], True).unionByName(parts[2], True)
    return one.agg(*[F.max(c).alias(c) for c in one.columns])
