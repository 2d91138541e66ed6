"""Model calls as Spark stages: prompts are columns, answers come back as JSON text and are parsed by Spark.

A model is any callable from a list of messages to a reply in chat-completion form. Without one, a
deterministic stub answers, so that plans and tests run offline.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill import dims
from assaymill.functions import text as T
from assaymill.functions.genes import strip
from assaymill.operators.ranking import top_per_group
from assaymill.session import settle
from assaymill.sources import pacing

Model = Callable[[list[dict]], dict]
MAX_RETRIES = 3


class RetryLater(Exception):
    """Raised by a model for an answer worth another try, with the wait it asks for."""

    def __init__(self, message: str, wait: float | None = None):
        super().__init__(message)
        self.wait = wait


def complete(model: Model, messages: list[dict], sleep=time.sleep) -> tuple[str | None, str | None]:
    """(content, error) of one call; up to three tries with growing waits, other failures are final."""
    for attempt in range(MAX_RETRIES):
        try:
            reply = model(messages)
            choice = reply["choices"][0]
            content = choice["message"]["content"] or ""
            if not content.strip():
                return None, f"empty_response: finish_reason={choice.get('finish_reason', 'unknown')}"
            return content, None
        except RetryLater as e:
            if attempt == MAX_RETRIES - 1:
                return None, f"api_error: {e}"
            sleep(e.wait if e.wait is not None else 2.0 ** attempt)
        except (KeyError, IndexError, TypeError) as e:
            return None, f"parse_failed: {e}"
        except Exception as e:  # a failed call is a row with an error, not a failed job
            return None, f"api_error: {e}"
    return None, "api_error: no attempt"


def ask(prompts: DataFrame, model: Model, calls_per_second: float | None = None) -> DataFrame:
    """`prompts` (…, system, prompt) with `reply` and `call_error` in place of the two message columns.

    Spark partitions the calls; `calls_per_second` bounds the first tries of the whole job (`sources.pacing`).
    """
    keep = [f for f in prompts.schema.fields if f.name not in ("system", "prompt")]
    names = [f.name for f in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep]
                       + ["reply string", "call_error string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wait = pacing.slots(calls_per_second)
        for b in batches:
            answers = []
            for system, prompt in zip(b["system"], b["prompt"]):
                wait()
                answers.append(complete(model, [{"role": "system", "content": system},
                                                {"role": "user", "content": prompt}]))
            out = b[names].copy()
            out["reply"] = [a[0] for a in answers]
            out["call_error"] = [a[1] for a in answers]
            yield out

    return pacing.dealt(prompts, calls_per_second).mapInPandas(run, schema)


def stub_model(messages: list[dict]) -> dict:
    """Deterministic stand-in for a triage model: the category follows from the prompt's length."""
    prompt = messages[-1]["content"]
    category = dims.TRIAGE_CATEGORIES[len(prompt) % len(dims.TRIAGE_CATEGORIES)]
    content = json.dumps({"category": category, "confidence": round((len(prompt) % 100) / 100, 2),
                          "reasoning": "stub", "base_protocols": [], "key_cell_types": [],
                          "supplement_signal": len(prompt) % 2 == 0, "disease_context": None})
    return {"choices": [{"message": {"content": content}, "finish_reason": "stop"}]}


# -- prompts ---------------------------------------------------------------------------------------------------

def triage_prompt(title: Column, article_type: Column, abstract: Column) -> Column:
    kind = F.when(F.coalesce(article_type, F.lit("")) != "", F.concat(F.lit("Article type: "), article_type))
    return F.concat_ws("\n\n", F.concat(F.lit("Title: "), title), kind,
                       F.concat(F.lit("Abstract:\n"), F.coalesce(abstract, F.lit(""))))


def structure_prompt(title: Column, text: Column) -> Column:
    return F.concat(F.lit("Paper title: "), title, F.lit("\n\n---\n\n"), text)


def arm_prompt(title: Column, arm_id: Column, arm: Column, structure: Column, text: Column) -> Column:
    return F.concat(F.lit("Paper title: "), title, F.lit("\nProtocol arm to extract: "), arm_id, F.lit(" — "), arm,
                    F.lit("\nPaper structure (from Pass 1): "), structure, F.lit("\n\n---\n\n"), text)


def supplement_prompt(title: Column, protocol: Column, supplement: Column) -> Column:
    return F.concat(F.lit("Paper title: "), title, F.lit("\n\nAlready extracted protocol (Pass 2):\n"), protocol,
                    F.lit("\n\n---\n\nSupplementary Materials:\n\n"), supplement)


def rnaseq_prompt(text: Column, accessions: Column, supplement: Column, budget: int | None = None, supplement_budget: int | None = None) -> Column:
    """Paper text and supplement, whole unless budgets in characters are given, with the known series as a hint."""
    text = text if budget is None else F.left(text, F.lit(budget))
    part = supplement if supplement_budget is None else F.left(supplement, F.lit(supplement_budget))
    hint = F.when(F.size(accessions) > 0, F.concat(
        F.lit("\n\nKnown GEO accessions for this paper: "), F.array_join(accessions, ", ")))
    extra = F.when(F.coalesce(supplement, F.lit("")) != "", F.concat(
        F.lit("\n\nSupplementary text:\n"), part))
    return F.concat(F.lit("Paper text:\n"), text,
                    F.coalesce(hint, F.lit("")), F.coalesce(extra, F.lit("")))


# -- answers ---------------------------------------------------------------------------------------------------

TRIAGE_SCHEMA = ("category string, confidence double, reasoning string, base_protocols array<string>, "
                 "supplement_signal boolean, key_cell_types array<string>, disease_context string")


def validate_triage(answers: DataFrame) -> DataFrame:
    """Triage records from replies: the category must be a known one, otherwise the error says why."""
    a = answers.withColumn("_r", F.from_json("reply", TRIAGE_SCHEMA))
    ok = F.try_parse_json("reply").isNotNull()
    error = (F.when(F.col("call_error").isNotNull(), F.col("call_error"))
             .when(~F.coalesce(ok, F.lit(False)), "parse_failed")
             .when(~F.coalesce(F.col("_r.category").isin(dims.TRIAGE_CATEGORIES), F.lit(False)),
                   F.concat(F.lit("invalid_category: "), F.coalesce("_r.category", F.lit("")))))
    none = F.array().cast("array<string>")
    return a.select(
        *[c for c in answers.columns if c not in ("reply", "call_error")],
        "_r.category", "_r.confidence", "_r.reasoning", F.coalesce("_r.base_protocols", none).alias("base_protocols"),
        F.coalesce("_r.supplement_signal", F.lit(False)).alias("supplement_signal"),
        F.coalesce("_r.key_cell_types", none).alias("key_cell_types"), "_r.disease_context", error.alias("error"))


def triage(papers: DataFrame, system: str, model: Model = stub_model) -> DataFrame:
    """Triage of paper metadata; papers without an abstract get that as their error and are not asked about."""
    has = strip(F.coalesce("abstract", F.lit(""))) != ""
    ids = papers.select("pmc_id", "doi", "pmid", "title", "article_type", "abstract")
    asked = ask(ids.where(has).select(
        "pmc_id", "doi", "pmid", "title", F.lit(system).alias("system"),
        triage_prompt(F.col("title"), F.col("article_type"), F.col("abstract")).alias("prompt")), model)
    silent = ids.where(~has).select("pmc_id", "doi", "pmid", "title", F.lit(None).cast("string").alias("reply"),
                                    F.lit("no_abstract").alias("call_error"))
    return validate_triage(asked.unionByName(silent))


def retry_errors(records: DataFrame) -> DataFrame:
    """Records to ask again one by one: any error but a missing abstract."""
    return records.where(F.col("error").isNotNull() & (F.col("error") != "no_abstract"))


def arms(structures: DataFrame) -> DataFrame:
    """Protocol arms of pass-1 replies `(paper_id, reply)`; a reply without arms stands for one main protocol."""
    schema = "protocol_arms array<struct<arm_id:string,arm_description:string,is_optimized:boolean,base_protocol_referenced:string>>"
    s = settle(structures.withColumn("_json", T.salvage_json(F.col("reply")))).where("_json IS NOT NULL")
    main = F.array(F.struct(
        F.lit("arm_1").alias("arm_id"), F.lit("main protocol").alias("arm_description"),
        F.lit(True).alias("is_optimized"), F.lit(None).cast("string").alias("base_protocol_referenced")))
    found = F.from_json("_json", schema)["protocol_arms"]
    return s.select("paper_id", F.col("_json").alias("structure"), F.inline(
        F.when(F.size(found) > 0, found).otherwise(main)))


PROTOCOL_SCHEMA = (
    "is_optimized boolean, cell_source struct<type:string,line_name:string,organism:string>, "
    "culture_system struct<format:string,substrate:string,oxygen_condition:string>, "
    "stages array<struct<stage_name:string,duration_days:string,base_medium:string,"
    "supplements:array<struct<name:string,concentration:string,concentration_unit:string>>,"
    "growth_factors:array<struct<name:string,concentration:string,concentration_unit:string>>,"
    "small_molecules:array<struct<name:string,concentration:string,concentration_unit:string>>,"
    "seeding_density:string,medium_change_frequency:string,"
    "stage_markers:array<struct<marker_name:string,value:string>>>>, "
    "endpoint_assessment struct<markers:array<struct<marker_name:string,value:string>>,"
    "functional_assays:array<struct<assay_name:string,value:string,unit:string>>>, "
    "base_protocol_doi string, extraction_confidence double, extraction_notes string")


def protocols_from_replies(answers: DataFrame, keep: list[str]) -> DataFrame:
    """Protocol rows from pass-2 replies; fenced or embedded JSON is salvaged, the rest is dropped."""
    a = settle(answers.withColumn("_json", T.salvage_json(F.col("reply")))).where("_json IS NOT NULL")
    return a.select(*keep, F.from_json("_json", PROTOCOL_SCHEMA).alias("p")).select(*keep, "p.*").withColumn(
        "pass_number", F.lit(2))


def flags_of_calls(calls: DataFrame) -> DataFrame:
    """Outcome of incomplete-field flags `(field, reason, details)` a model raised."""
    field, reason = F.trim(F.coalesce("field", F.lit(""))), F.trim(F.coalesce("reason", F.lit("")))
    error = (F.when(field == "", "Missing 'field' parameter")
             .when(~reason.isin(dims.FLAG_REASONS), F.concat(F.lit("Invalid reason '"), reason, F.lit("'"))))
    details = F.trim(F.coalesce("details", F.lit("")))
    message = F.concat(F.lit("Recorded: '"), field, F.lit("' is incomplete ("), reason, F.lit(")."),
                       F.when(details != "", F.concat(F.lit(" Details: "), details)).otherwise(F.lit("")))
    return (calls.withColumn("error", error)
            .withColumn("status", F.when(error.isNull(), "flagged").otherwise("rejected"))
            .withColumn("message", F.when(error.isNull(), message)))


def cap_tool_calls(calls: DataFrame, key: list[str], order: str, limit: int = 5) -> DataFrame:
    """Tool calls per conversation up to the limit after which no more are offered."""

    return top_per_group(calls, key, [order], limit, [order], "call_no")


def merge_supplement(protocols: DataFrame, updates: DataFrame) -> DataFrame:
    """Pass-3 additions `(id, no_additional_data, markers, functional_assays, stage_updates, notes)` merged in.

    A marker or assay is appended unless the protocol already names it; a name that is new but doubled in the
    addition comes in twice. Stage markers go to the stages of that name. The pass becomes 3.
    """
    u = updates.where(~F.coalesce("no_additional_data", F.lit(False))).select(
        "id", F.col("markers").alias("_m"), F.col("functional_assays").alias("_a"),
        F.col("stage_updates").alias("_s"), F.col("notes").alias("_notes"), F.lit(True).alias("_hit"))
    j = protocols.join(u, "id", "left")

    def added(old, new, name):
        old = F.coalesce(old, F.array())
        fresh = F.filter(F.coalesce(new, F.array()), lambda n: ~F.exists(old, lambda o: o[name] == n[name]))
        return F.concat(old, fresh)

    ea = F.col("endpoint_assessment")
    merged_ea = F.struct(
        added(ea["markers"], F.col("_m"), "marker_name").alias("markers"),
        added(ea["functional_assays"], F.col("_a"), "assay_name").alias("functional_assays"))

    def stage(s):
        extra = F.flatten(F.transform(
            F.filter("_s", lambda x: x["stage_name"] == s["stage_name"]), lambda x: x["additional_markers"]))
        return s.withField("stage_markers", F.when(F.size(extra) > 0, added(s["stage_markers"], extra, "marker_name"))
                           .otherwise(s["stage_markers"]))

    hit = F.col("_hit")
    note = F.concat(F.lit("Pass 3: "), F.col("_notes"))
    touch = F.col("_m").isNotNull() | F.col("_a").isNotNull()
    return (j.withColumn("endpoint_assessment", F.when(hit & touch, merged_ea).otherwise(ea))
            .withColumn("stages", F.when(hit & F.col("_s").isNotNull(), F.transform("stages", stage)).otherwise(F.col("stages")))
            .withColumn("extraction_notes", F.when(
                hit & (F.coalesce("_notes", F.lit("")) != ""), T.append_note(F.col("extraction_notes"), note))
                .otherwise(F.col("extraction_notes")))
            .withColumn("pass_number", F.when(hit, 3).otherwise(F.col("pass_number")))
            .select(*protocols.columns))


def review_rows(answers: DataFrame) -> DataFrame:
    """Review replies as protocol rows: the findings live as JSON in the notes."""
    schema = "extraction_confidence double"
    a = settle(answers.withColumn("_json", T.salvage_json(F.col("reply")))).where("_json IS NOT NULL")
    parts = {"protocol_references": "protocol_references", "protocol_comparisons": "protocol_comparisons",
             "methodological_insights": "methodological_insights",
             "differentiation_papers": "differentiation_papers_in_references"}
    notes = F.concat(F.lit("{"), F.concat_ws(", ", *[
        F.concat(F.lit(f'"{k}": '), F.coalesce(F.get_json_object("_json", f"$.{v}"), F.lit("[]")))
        for k, v in parts.items()]), F.lit("}"))
    return a.select(
        "paper_id", F.lit("review").alias("protocol_arm"), F.lit(False).alias("is_optimized"),
        F.coalesce(F.from_json("_json", schema)["extraction_confidence"], F.lit(0.0)).alias("extraction_confidence"),
        notes.alias("extraction_notes"), F.lit(1).alias("pass_number"))
