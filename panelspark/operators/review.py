"""Detections to a review queue, and an append-only log of decisions on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions import text
from panelspark.functions.text import short_id

#: Severities, the most serious first; fixed values.
SEVERITIES = ("SEV1-H", "SEV1", "SEV2", "SEV3")


def severity_rank(c: Column) -> Column:
    """1 for the most serious; unknown ones come last."""
    at = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), c)
    return F.when(at > 0, at).otherwise(len(SEVERITIES) + 1)


def consolidate(detections: DataFrame, keys: list[str], detector: str = "detector", severity: str = "severity", signal: str = "signal") -> DataFrame:
    """One row for each key: detectors and signals joined in order, the most serious severity, an id."""
    row = F.struct(severity_rank(F.col(severity)).alias("r"), F.col(detector).alias("d"), F.col(signal).alias("s"), F.col(severity).alias("v"))
    x = detections.groupBy(*keys).agg(F.array_sort(F.collect_set(row)).alias("_d"))
    return x.select(
        *keys,
        short_id(*[F.col(k).cast("string") for k in keys]).alias("id"),
        F.get("_d", F.lit(0))["v"].alias("severity"),
        F.array_join(F.array_distinct(F.transform("_d", lambda d: d["d"])), "|").alias("detectors"),
        F.array_join(F.transform("_d", lambda d: d["s"]), " | ").alias("signals"),
        F.size("_d").cast("long").alias("n_detections"),
    )


def queue_rows(detections: DataFrame, keys: list[str], arrival: str, detector: str = "detector", severity: str = "severity", signal: str = "signal") -> DataFrame:
    """One queue row for each key, by seriousness, then arrival: detectors once each joined by ",", every signal after its detector's name joined by " | "."""
    row = F.struct(severity_rank(F.col(severity)).alias("r"), F.col(arrival).alias("a"), F.col(detector).alias("d"), F.coalesce(signal, F.lit("")).alias("s"), F.col(severity).alias("v"))
    x = detections.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_d"))
    return x.select(
        *keys,
        short_id(*[F.col(k).cast("string") for k in keys]).alias("id"),
        F.get("_d", F.lit(0))["v"].alias("severity"),
        F.array_join(F.array_distinct(F.transform("_d", lambda d: d["d"])), ",").alias("detectors"),
        F.array_join(F.transform("_d", lambda d: F.concat(d["d"], F.lit(": "), d["s"])), " | ").alias("signals"),
    )


def latest_decisions(log: DataFrame, key: str, time: str, position: str) -> DataFrame:
    """The last decision of each id; of equal times the later row. A map-side maximum."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(time, position)).alias("_r")).select(key, "_r.*")


def overlay(queue: DataFrame, decisions: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The queue with the decisions' columns, blank where undecided."""
    return queue.drop(*columns).join(decisions.select(key, *columns), key, "left").select(*[c for c in queue.columns if c not in columns], *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])


def ranked(queue: DataFrame, severity: str = "severity", then: tuple[str, ...] = ()) -> DataFrame:
    return queue.orderBy(severity_rank(F.col(severity)), *then)


def split_by_decision(decided: DataFrame, decision: str, kinds: dict[str, list[str]]) -> dict[str, DataFrame]:
    """A DataFrame for each output, of the decisions that feed it."""
    return {name: decided.filter(F.col(decision).isin(*values)) for name, values in kinds.items()}


def provenance(decision: Column, option: Column, labels: dict[str, str]) -> Column:
    """A label for a decision and its option: "decision:option" first, then "decision"."""
    out = F.lit(None).cast("string")
    for k, v in labels.items():
        if ":" not in k:
            out = F.when(decision == k, F.lit(v)).otherwise(out)
    for k, v in labels.items():
        if ":" in k:
            d, o = k.split(":", 1)
            out = F.when((decision == d) & (option == o), F.lit(v)).otherwise(out)
    return out


def next_pending(queue: DataFrame, position: str, after: int, decision: str) -> DataFrame:
    """The next undecided row after a position, going round."""
    return queue.filter(F.coalesce(F.col(decision), F.lit("")) == "").orderBy((F.col(position) <= after).cast("int"), position).limit(1)


def minor_edits(decided: DataFrame, documents: DataFrame, key: str, notes: Column, fields: dict[str, str]) -> DataFrame:
    """Edits in "field=value" notes, of listed fields (name to the documents' column) only: key, field, before, after."""
    edits = decided.select(key, F.explode(F.filter(F.map_entries(text.key_values(notes)), lambda e: e["key"].isin(*fields))).alias("_e"))
    before = F.coalesce(*[F.when(F.col("_e.key") == name, F.col(column).cast("string")) for name, column in fields.items()], F.lit(""))
    return edits.join(documents, key).select(key, F.col("_e.key").alias("field"), before.alias("before"), F.col("_e.value").alias("after"))


def overrides(decided: DataFrame, documents: DataFrame, key: str, new: str, old: str) -> DataFrame:
    """Types that a decision sets and the document doesn't have yet, traced: key, field, before, after."""
    x = decided.select(key, F.col(new).alias("after")).join(documents.select(key, F.coalesce(F.col(old), F.lit("")).alias("before")), key)
    return x.filter("before <> after").select(key, F.lit(old).alias("field"), "before", "after")


def run(detections: DataFrame, log: DataFrame, keys: list[str], arrival: str, time: str, position: str) -> DataFrame:
    """A whole run: detections to queue rows, the log's last decisions (id, decision, notes) laid over them, in order of seriousness and keys.

    The queue is made anew from the detections, so a decision whose case is gone stays in the log only.
    """
    queue = queue_rows(detections, keys, arrival).withColumns({"decision": F.lit(""), "notes": F.lit("")})
    return ranked(overlay(queue, latest_decisions(log, "id", time, position), "id", ["decision", "notes"]), then=tuple(keys))


def runs_compared(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Two runs' summaries (keys, scheme, n) side by side: new, lost, another scheme, another number of rows, or the same."""
    a = before.select(*keys, F.col("scheme").alias("_s0"), F.col("n").alias("before_n"))
    b = after.select(*keys, F.col("scheme").alias("_s1"), F.col("n").alias("after_n"))
    outcome = F.when(F.col("before_n").isNull(), "new").when(F.col("after_n").isNull(), "lost").when(~F.col("_s0").eqNullSafe(F.col("_s1")), "scheme").when(F.col("before_n") != F.col("after_n"), "rows").otherwise("same")
    shown = lambda c: F.coalesce(F.col(c), F.lit("—"))
    return a.join(b, keys, "full").select(*keys, shown("_s0").alias("before_scheme"), shown("_s1").alias("after_scheme"), "before_n", "after_n", (F.col("after_n") - F.col("before_n")).alias("delta_n"), outcome.alias("outcome"))


def patched(index: DataFrame, patch: DataFrame, key: str, where: Column, columns: list[str], status: str, label: str) -> DataFrame:
    """An index whose rows inside ``where`` take their columns from a patch (one row for each key) that has their key."""
    found = patch.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns])
    hit = where & F.coalesce(F.col("_hit"), F.lit(False))
    x = index.join(found, key, "left").withColumns({c: F.when(hit, F.coalesce(F.col(f"_{c}"), F.col(c))).otherwise(F.col(c)) for c in columns} | {status: F.when(hit, label).otherwise(F.col(status))})
    return x.select(*index.columns)
