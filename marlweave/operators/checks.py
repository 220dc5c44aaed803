"""Integrity checks and maintenance plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lifecycle import isolated


def integrity(docs: DataFrame, vectors: DataFrame, entities: DataFrame, mentions: DataFrame, edges: DataFrame) -> DataFrame:
    """(check_name, n): documents without a vector, nodes without any edge."""
    bare = docs.join(vectors.where("vector IS NOT NULL").select("id").distinct(), "id", "left_anti")
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check_name"), "n")
    return count(bare, "documents_without_vector").unionByName(count(isolated(entities, mentions, edges), "entities_without_edge"))


def complete(status: DataFrame, tags: dict[str, str]) -> DataFrame:
    """(source_key, complete): whether every phase of a source is done with its current tag. status has source_key, phase, state, tag."""
    want = F.create_map(*[F.lit(x) for p in tags.items() for x in p])
    done = F.coalesce((F.col("state") == "done") & (F.col("tag") == want[F.col("phase")]), F.lit(False))
    return status.groupBy("source_key").agg((F.bool_and(done) & (F.count_distinct(F.when(done, F.col("phase"))) == len(tags))).alias("complete"))


def missing_status(docs: DataFrame, status: DataFrame) -> DataFrame:
    """Sources with documents but without a status."""
    return docs.select("source_key").distinct().join(status.select("source_key").distinct(), "source_key", "left_anti")


def failed_phases(status: DataFrame) -> DataFrame:
    """(source_key, phases): the failed phases of each source that has one."""
    return status.where("state = 'error'").groupBy("source_key").agg(F.concat_ws(",", F.sort_array(F.collect_set("phase"))).alias("phases"))


def with_dependents(needs: dict[str, list[str]], phases: list[str]) -> list[str]:
    """The phases asked for and all that depend on them, however indirectly."""
    out = list(dict.fromkeys(phases))
    todo = list(out)
    while todo:
        now = todo.pop()
        for p in (p for p, before in needs.items() if now in before and p not in out):
            out.append(p)
            todo.append(p)
    return sorted(out)


def due_after_transfer(status: DataFrame, since: str | None) -> DataFrame:
    """Sources whose graph phases are due after a store was transferred: those last updated before it, all without a record."""
    return (status if since is None else status.where(F.col("updated_at") < F.to_timestamp(F.lit(since)))).select("source_key").distinct()


def drifted(collections: DataFrame, name: str, size: int) -> DataFrame:
    """(drifted): whether a collection was made with another embedder."""
    other = (F.col("embedder_name") != name) | (F.col("embedder_size") != size)
    return collections.agg(F.coalesce(F.bool_or(other), F.lit(False)).alias("drifted"))


def generation_current(marker: str | None, fingerprint: str) -> bool:
    """Whether the active generation of concepts is that of the settings."""
    return marker == fingerprint


def plan(status: DataFrame, tags: dict[str, str], drift: bool = False) -> DataFrame:
    """(source_key, action): what maintenance would do with each source: resume (a phase failed), reingest (the source was never parsed to the end), reembed (another embedder), graph (a graph phase isn't done with its current tag) or none. status has source_key, phase, state and tag."""
    failed = F.bool_or(F.col("state") == "error")
    current = F.coalesce((F.col("state") == "done") & (F.col("tag") == F.create_map(*[F.lit(x) for p in tags.items() for x in p])[F.col("phase")]), F.lit(False))
    stored = F.coalesce(F.bool_or((F.col("phase") == "embedding") & (F.col("state") == "done")), F.lit(False))
    held = status.groupBy("source_key").agg(failed.alias("failed"), stored.alias("stored"), F.bool_and(F.col("phase").isin("embedding") | current).alias("graph"))
    action = F.when(F.col("failed"), "resume").when(~F.col("stored"), "reingest").when(F.lit(drift), "reembed").when(~F.col("graph"), "graph").otherwise("none")
    return held.select("source_key", action.alias("action"))


def exit_code(done: list[bool], verified: bool, dry_run: bool = False) -> int:
    """How a maintenance run ends: 2 if it only showed its plan, 0 if every step and the check afterwards succeeded, else 1."""
    return 2 if dry_run else 0 if all(done) and verified else 1
