"""What follows from decisions: one routed table, and each output a filter on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions import text

#: Decisions on queue rows and the origin each gives its document; fixed values.
ORIGINS = {"confirmar_ok": "confirmado_fiel", "propagar_previo": "propagado_previo", "corregir_previo": "corregido_previo", "reextraer": "reextraido", "re_segmentar": "resegmentado", "sin_ley": "sin_ley", "ignorar": "ignorado"}
#: A confirmation with a minor change has an origin of its own; fixed values.
MINOR, MINOR_ORIGIN = "cambio_menor", "confirmado_cambio_menor"


def _clean(c: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))


def routed(decided: DataFrame, documents: DataFrame, entity: str = "entity", year: str = "year") -> DataFrame:
    """One row for each decision (id, entity, year, decision, option, notes) with its outcome and what it asks for.

    ``documents`` holds entity and year of the documents there are, each once. Columns added: outcome (done, error, invalid or
    undecided), origin, copy_from and copy_to (years of a propagation or correction), pages, pdf, hint_type, force_vision,
    hint (notes for the next extraction), minor (whether minor edits apply) and closes (the cell has no law). An error asks for nothing.
    """
    here = documents.select(entity, year, F.lit(True).alias("_here"))
    prior = documents.select(entity, (F.col(year) + 1).alias(year), F.lit(True).alias("_prior"))
    d, option, notes = F.col("decision"), F.col("option"), F.coalesce(F.col("notes"), F.lit(""))
    x = decided.withColumns({"decision": _clean("decision"), "option": _clean("option")}).join(here, [entity, year], "left").join(prior, [entity, year], "left")
    hint = lambda k: F.coalesce(F.try_element_at(F.col("_hints"), F.lit(k)), F.lit(""))
    segment_pages = F.trim(F.regexp_extract(notes, "paginas\\s*=\\s*([\\d,\\s-]+)", 1))
    segment_pdf = F.regexp_extract(notes, "pdf\\s*=\\s*(\\S+)", 1)
    has, had = F.col("_here").isNotNull(), F.col("_prior").isNotNull()
    failed = F.when(d == "propagar_previo", ~(has & had)).when(d == "corregir_previo", ~has).when(d == "re_segmentar", segment_pages == "").otherwise(False)
    outcome = F.when(d == "", "undecided").when(~d.isin(*ORIGINS), "invalid").when(failed, "error").otherwise("done")
    origin = F.when((d == "confirmar_ok") & (option == MINOR), MINOR_ORIGIN)
    for name, label in ORIGINS.items():
        origin = origin.when(d == name, label)
    x = x.withColumns({"outcome": outcome, "_hints": text.key_values(notes)})
    done, again = F.col("outcome") == "done", d == "reextraer"
    only = lambda when, value: F.when(done & when, value)
    both = lambda a, b: F.when(done & again, F.nullif(a, F.lit(""))).when(done & (d == "re_segmentar"), F.nullif(b, F.lit("")))
    return x.withColumns({
        "origin": only(F.lit(True), origin),
        "copy_from": only(d == "propagar_previo", F.col(year) - 1).when(done & (d == "corregir_previo"), F.col(year)),
        "copy_to": only(d == "propagar_previo", F.col(year)).when(done & (d == "corregir_previo"), F.col(year) - 1),
        "pages": both(hint("paginas"), segment_pages),
        "pdf": both(hint("pdf"), segment_pdf),
        "hint_type": only(again, F.nullif(hint("hint_tipo"), F.lit(""))),
        "force_vision": done & again & F.lower(hint("force_vision")).isin("1", "true", "yes"),
        "hint": only(again, F.nullif(F.coalesce(F.nullif(hint("hint_notas"), F.lit("")), notes), F.lit(""))).when(done & (d == "re_segmentar"), notes),
        "minor": done & (option == MINOR) & d.isin("confirmar_ok", "propagar_previo", "corregir_previo"),
        "closes": done & (d == "sin_ley") & has,
    }).drop("_here", "_prior", "_hints")


def outputs(routes: DataFrame) -> dict[str, DataFrame]:
    """The outputs of routed decisions, each a filter: log, copies, edits, page overrides, extraction queue, closed cells, failures."""
    done = routes.filter("outcome = 'done'")
    return {
        "log": done,
        "copies": done.filter("copy_to IS NOT NULL"),
        "edits": done.filter("minor"),
        "overrides": done.filter("pages IS NOT NULL"),
        "queue": done.filter("decision IN ('reextraer', 're_segmentar')").withColumn("processed", F.lit("")),
        "closed": done.filter("closes"),
        "failures": routes.filter("outcome IN ('error', 'invalid')"),
    }


def output_names() -> Column:
    """For a row of ``routed``, which of ``outputs`` take it: an array of names, so that all are made in one pass."""
    done = F.col("outcome") == "done"
    rules = {
        "log": done,
        "copies": done & F.col("copy_to").isNotNull(),
        "edits": done & F.col("minor"),
        "overrides": done & F.col("pages").isNotNull(),
        "queue": done & F.col("decision").isin("reextraer", "re_segmentar"),
        "closed": done & F.col("closes"),
        "failures": F.col("outcome").isin("error", "invalid"),
    }
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))


def audit_result(decision: Column, right_type: Column, pdf: Column, pages: Column, notes: Column, known: Column) -> Column:
    """What an audit's decision leads to; ``known`` says whether the row names its cell."""
    there = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    d = F.lower(F.trim(F.coalesce(decision, F.lit(""))))
    assumed = F.coalesce(notes.rlike("(?is)\\basumir\\b.*\\banterior\\b"), F.lit(False))
    error = F.when(there(pdf) & there(pages), "reextract").when(assumed, "impute_previous").when(there(right_type), "override")
    return (
        F.when(d == "", "undecided").when(~known, "incomplete").when(d == "exclude_muni", "excluded").when(d == "accept_as_is", "accepted")
        .when(d == "real_reform", F.when(there(right_type), "reform_override").otherwise("reform")).when(d == "extraction_error", F.coalesce(error, F.lit("no_action"))).otherwise("unknown")
    )


def audit_lists(rows: DataFrame, entity: str, order: str, result: str = "result") -> DataFrame:
    """Entities excluded, with a real reform, or accepted as they are, with the last row that says so: list, entity, row."""
    of = F.when(F.col(result) == "excluded", "excluded").when(F.col(result).startswith("reform"), "real_reform").when(F.col(result) == "accepted", "non_absorbing")
    rest = [c for c in rows.columns if c != entity]
    last = rows.withColumn("list", of).filter("list IS NOT NULL").groupBy("list", entity).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return last.select("list", entity, "_r.*")


def reextraction_result(status: Column, year: Column, notes: Column, pdf: Column, pages: Column, real: Column, known: Column) -> Column:
    """Struct result, from_year, first_page, last_page of an audited gap; ``real`` says whether a real document stands there."""
    s, there = F.lower(F.trim(F.coalesce(status, F.lit("")))), lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    source = F.nullif(F.regexp_extract(F.coalesce(notes, F.lit("")), "(?i)imputar\\s+con\\s+datos\\s+de\\s+(\\d{4})", 1), F.lit("")).cast("int")
    numbers = F.transform(F.regexp_extract_all(F.coalesce(pages, F.lit("")), F.lit("\\d+"), F.lit(0)), lambda n: n.cast("int"))
    none = F.when(source.isNull(), "no_law").when(source == year, "own_year").otherwise("impute_from")
    found = F.when(~(there(pdf) & there(pages)), "no_pages").when(F.size(numbers) == 0, "bad_pages").otherwise("extract")
    result = F.when(s == "", "undecided").when(~known, "incomplete").when(F.coalesce(real, F.lit(False)), "exists").when(s == "no_existe_ley", none).when(s == "encontrado", found).otherwise("unexpected")
    at = lambda c: F.when(result == "extract", c)
    # "47-52" is a range as written; a list of pages spans from its least to its greatest
    as_range = F.trim(pages).rlike("^\\d+\\s*[-–—]\\s*\\d+$")
    first = F.when(as_range, F.get(numbers, F.lit(0))).otherwise(F.array_min(numbers))
    last = F.when(as_range, F.get(numbers, F.lit(1))).otherwise(F.array_max(numbers))
    return F.struct(result.alias("result"), F.when(result == "impute_from", source).alias("from_year"), at(first).alias("first_page"), at(last).alias("last_page"))


def consumed(queue: DataFrame, results: DataFrame, key: str, time: Column) -> DataFrame:
    """The queue after a run: pending rows get "ok", "error_sin_output" or "error: ..." and the time; the others stay as they are.

    ``results`` has key, produced (how many outputs, null if none ran) and error; a pending row without a result stays pending.
    """
    status = F.when(F.col("error").isNotNull(), F.concat(F.lit("error: "), F.substring("error", 1, 100))).when(F.col("produced") > 0, "ok").otherwise("error_sin_output")
    x = queue.join(results.select(key, "produced", "error", F.lit(True).alias("_ran")), key, "left")
    turned = (F.trim(F.coalesce("processed", F.lit(""))) == "") & F.coalesce("_ran", F.lit(False))
    x = x.withColumns({"processed": F.when(turned, status).otherwise(F.coalesce("processed", F.lit(""))), "processed_at": F.when(turned, time).otherwise(F.col("processed_at"))})
    return x.select(*queue.columns)


def cases_to_review(documents: DataFrame, kind: str, model: str, flagged: str, synthetic: tuple[str, ...], escape: str = "otro_no_clasificado") -> DataFrame:
    """Documents for the review book with their list: escape types first, others that are flagged; synthetic ones are left out."""
    of = F.when(F.coalesce(F.col(kind) == escape, F.lit(False)), "escape").when(F.col(flagged), "flagged")
    real = ~F.coalesce(F.col(model).isin(*synthetic), F.lit(False))
    return documents.filter(real).withColumn("list", of).filter("list IS NOT NULL").withColumn(kind, F.coalesce(kind, F.lit("FALTA_PREDIAL")))


def corrections(corrected: DataFrame, valid: Column, batch: str) -> DataFrame:
    """Corrected documents with valid and copied: a batch is copied only if all of it is valid. Counts are joined back, so no batch is one task."""
    x = corrected.withColumn("valid", F.coalesce(valid, F.lit(False)))
    clean = x.groupBy(batch).agg(F.min("valid").alias("copied"))
    return x.join(clean, batch)


def repairs(audit: DataFrame, action: Column, kinds: dict[str, list[str]]) -> DataFrame:
    """Audit rows with the repair (re-extract, re-segment, re-run) that their action asks for; the others are left out."""
    of = F.lit(None).cast("string")
    for kind, actions in kinds.items():
        of = F.when(action.isin(*actions), kind).otherwise(of)
    return audit.withColumn("repair", of).filter("repair IS NOT NULL")


def cascade(attempts: DataFrame, key: str, stage: str, output: str, error: str, cost: str) -> DataFrame:
    """Attempts of a cascade: key, stage (of the first with an output, null if none), output, tried, cost, history, review.

    Stages after the first success would not have run: they count in neither cost nor history.
    """
    first = attempts.groupBy(key).agg(F.min(F.when(F.col(output).isNotNull(), F.col(stage))).alias("_s"))
    ran = attempts.join(first, key).filter(F.col("_s").isNull() | (F.col(stage) <= F.col("_s")))
    failed = F.when(F.col(output).isNull(), F.struct(F.col(stage).alias("s"), F.concat(F.lit("e"), F.col(stage).cast("string"), F.lit("="), F.coalesce(F.col(error).cast("string"), F.lit(""))).alias("e")))
    return ran.groupBy(key).agg(
        F.first("_s").alias("stage"),
        F.min_by(output, F.when(F.col(output).isNotNull(), F.col(stage))).alias("output"),
        F.count("*").alias("tried"),
        F.sum(cost).alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(failed)), lambda e: e["e"]), "; ").alias("history"),
    ).withColumn("review", F.col("stage").isNull())
