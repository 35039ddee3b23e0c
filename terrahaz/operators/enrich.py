"""Table work around model replies: prompts, extraction, parsing, judging, scoring.

Model calls are injected callables; replies are untrusted text and no parser throws.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrahaz.functions import classify as C

HAZARD_FIELDS = ("hazard_type", "description", "severity", "location", "timestamp")
#: Fields every hazard must have; the other two only where the text mentions them.
REQUIRED_FIELDS = HAZARD_FIELDS[:3]
HAZARDS = "array<struct<" + ", ".join(f"{f} string" for f in HAZARD_FIELDS) + ">>"

# Defaults of the reply parser and the words of the default extractor.
DEFAULT_SEVERITY = 5
DEFAULT_HAZARD = "unknown"
MISSING_JUDGE_SCORE = 0.5
QUARANTINE_BELOW = 3.0
SEVERITY_WORDS = {"low": 2, "medium": 5, "high": 8, "critical": 10}
KEYWORD_HAZARDS = {
    "weather": ["turbulence", "storm", "wind", "rain", "fog"],
    "mechanical": ["engine", "hydraulic", "fuel"],
    "procedural": ["incursion", "clearance"],
    "environmental": ["bird"],
    "medical": ["medical", "cardiac"],
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -------------------------------------------------------------------- parsing


def parse_ai_enrichment(reply) -> Column:
    """``struct<ai_severity int, ai_hazard_type string>``; any bad part takes its default."""
    reply = _col(reply)
    raw = F.get_json_object(reply, "$.severity").try_cast("double")
    severity = F.coalesce(
        F.when(~F.isnan(raw), C.clip(raw, 1.0, 10.0).cast("int")), F.lit(DEFAULT_SEVERITY)
    )
    hazard = F.coalesce(C.first_of(F.get_json_object(reply, "$.hazard_type")), F.lit(DEFAULT_HAZARD))
    return F.struct(severity.alias("ai_severity"), hazard.alias("ai_hazard_type"))


def parse_hazard_array(reply) -> Column:
    """The hazards of a reply: the text as an array, else the first array inside prose."""
    text = F.trim(_col(reply))
    whole = F.when(text.startswith("["), F.from_json(text, HAZARDS))
    embedded = F.regexp_extract(text, r"(?s)(\[\s*\{.*\}\s*\])", 1)
    inside = F.when(embedded != "", F.from_json(embedded, HAZARDS))
    return F.coalesce(whole, inside, F.from_json(F.lit("[]"), HAZARDS))


def explode_hazards(df: DataFrame, hazards: str) -> DataFrame:
    """One row per hazard (rows without any stay), with their number."""
    numbered = df.withColumn("num_hazards", F.size(hazards))
    exploded = numbered.withColumn("__h", F.explode_outer(hazards)).drop(hazards)
    fields = [F.col(f"__h.{n}").alias(n) for n in HAZARD_FIELDS]
    return exploded.select(*[c for c in exploded.columns if c != "__h"], *fields)


def parse_judge_score(reply) -> Column:
    found = F.regexp_extract(F.coalesce(_col(reply), F.lit("")), r'"score"\s*:\s*([0-9.]+)', 1)
    return F.coalesce(found.try_cast("double"), F.lit(MISSING_JUDGE_SCORE))


def token_usage(prompt, completion) -> Column:
    p, c = F.coalesce(_col(prompt), F.lit(0)), F.coalesce(_col(completion), F.lit(0))
    return F.struct(p.alias("prompt_tokens"), c.alias("completion_tokens"), (p + c).alias("total_tokens"))


def final_severity(ai, source) -> Column:
    """AI severity if usable, else the source's, else 5; clamped to 1..10."""

    def level(c) -> Column:
        text = F.lower(F.trim(_col(c).cast("string")))
        return F.coalesce(text.try_cast("double"), C.lookup(text, SEVERITY_WORDS).cast("double"))

    chosen = F.coalesce(level(ai), level(source), F.lit(float(DEFAULT_SEVERITY)))
    return C.clip(F.round(chosen, 0), 1.0, 10.0).cast("int")


# -------------------------------------------------------------------- prompts

TEMPLATES = [
    (
        "hazard_extraction", "1", "{{input_text}}",
        "Extract every hazard in the report as a JSON array of objects with the fields "
        "hazard_type, description and severity, and location and timestamp where the report "
        "names them. Reply [] if there is none.\n\nReport:\n{{input_text}}",
        "structured_extraction",
    ),
    (
        "extraction_judge", "1", "{{source_text}}",
        "Say how well the extraction is supported by the text, as JSON with the fields "
        "score (0.0 to 1.0) and reason.\n\nText:\n{{source_text}}\n\nExtraction:\n{{extracted_json}}",
        "judge_evaluation",
    ),
]


def templates(spark: SparkSession) -> DataFrame:
    """The prompt templates as a small versioned table."""
    return spark.createDataFrame(
        TEMPLATES, "name string, version string, placeholder string, template string, purpose string"
    )


def template_text(name: str, version: str = "1") -> str:
    for n, v, _, text, _ in TEMPLATES:
        if (n, v) == (name, version):
            return text
    raise ValueError(f"no template {name} version {version}")


def render_prompt(template: str, values: dict[str, Column]) -> Column:
    """Fill ``{{name}}`` placeholders per row; a null value becomes empty text.

    The template is cut at its placeholders, so text that itself contains a placeholder
    is never filled a second time.
    """
    parts, rest = [], template
    while "{{" in rest:
        head, _, tail = rest.partition("{{")
        name, _, rest = tail.partition("}}")
        parts += [F.lit(head), F.coalesce(values[name].cast("string"), F.lit(""))]
    return F.concat(*parts, F.lit(rest))


# ----------------------------------------------------------------- extraction


def keyword_hazards(text) -> Column:
    """Default extractor: one hazard per category whose words occur. Native expressions."""
    lowered = F.lower(_col(text))
    found = [
        F.when(
            C.any_word(lowered, words),
            F.struct(
                F.lit(kind).alias("hazard_type"),
                F.concat(F.lit("mentions "), F.lit(kind)).alias("description"),
                F.lit("medium").alias("severity"),
            ),
        )
        for kind, words in KEYWORD_HAZARDS.items()
    ]
    return F.array_compact(F.array(*found))


EXTRACTION = (
    "extracted_hazards string, status string, latency double, "
    "prompt_tokens bigint, completion_tokens bigint, num_hazards int, error string"
)


def extract_native(df: DataFrame, text: str) -> DataFrame:
    """Extraction with the keyword extractor: same columns as ``batch_extract``, no Python."""
    empty = F.coalesce(F.trim(text), F.lit("")) == ""
    found = df.withColumn("__hazards", F.when(~empty, keyword_hazards(text)))
    skipped = F.col("__hazards").isNull()
    reply = F.when(skipped, "[]").otherwise(F.to_json("__hazards"))
    return (
        found.withColumn("extracted_hazards", reply)
        .withColumns(
            {
                "status": F.when(skipped, "skipped").otherwise("success"),
                "prompt_tokens": F.when(~skipped, C.token_count(text).cast("bigint")),
                "completion_tokens": F.when(~skipped, C.token_count("extracted_hazards").cast("bigint")),
                "num_hazards": F.when(skipped, 0).otherwise(F.size("__hazards")),
                "latency": F.lit(None).cast("double"),
                "error": F.lit(None).cast("string"),
            }
        )
        .drop("__hazards")
    )


def _answer(replies: list, at: int, failed: str | None) -> tuple:
    """(reply, prompt tokens, completion tokens, error) of one prompt; a reply that is missing or
    malformed gets the default and says so, and costs no other prompt anything."""
    if failed is None:
        try:
            reply = replies[at]
            text, counts = reply.get("response"), [int(reply.get(f) or 0) for f in ("prompt_tokens", "completion_tokens")]
            return ("[]" if text is None else str(text)), *counts, None
        except Exception as e:  # noqa: BLE001 - whatever the model sent becomes data
            failed = f"malformed reply: {type(e).__name__}: {e}"
    return "[]", 0, 0, failed


def batch_call(
    df: DataFrame, key: str, prompt: Column, asked: Column, call: Callable[[list[str]], list[dict]]
) -> DataFrame:
    """``key, reply, status, latency, prompt_tokens, completion_tokens, error``: the model is called
    once per Arrow batch with the prompts of the rows where ``asked`` holds; the others are skipped.

    A failing call costs its batch the default reply and notes the error; it does not fail the job.
    """
    reply_type = "reply string, status string, latency double, prompt_tokens bigint, completion_tokens bigint, error string"
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame({key: batch[key]})
            filled = batch["prompt"].notna()
            out["reply"], out["status"], out["error"] = "[]", "skipped", None
            out["latency"] = float("nan")
            out["prompt_tokens"] = pd.array([None] * len(out), dtype="Int64")
            out["completion_tokens"] = pd.array([None] * len(out), dtype="Int64")
            if filled.any():
                prompts, started = batch.loc[filled, "prompt"].tolist(), time.time()
                try:
                    got, failed = list(call(prompts)), None
                except Exception as failure:  # noqa: BLE001 - any model failure becomes data
                    got, failed = [], str(failure)
                answers = [_answer(got, i, failed) for i in range(len(prompts))]
                out.loc[filled, "latency"] = (time.time() - started) / len(prompts)
                for at, field in enumerate(("reply", "prompt_tokens", "completion_tokens", "error")):
                    out.loc[filled, field] = [a[at] for a in answers]
                out.loc[filled, "status"] = ["success" if a[3] is None else "error" for a in answers]
            yield out

    rows = df.select(key, F.when(asked, prompt).alias("prompt"))
    replies = rows.mapInPandas(run, f"{key} {key_type}, {reply_type}")
    return replies.withColumn("latency", F.nanvl("latency", F.lit(None).cast("double")))


def batch_extract(
    df: DataFrame, text: str, call: Callable[[list[str]], list[dict]], key: str,
    template: str | None = None, placeholder: str = "input_text",
) -> DataFrame:
    """Fill the extraction template with each text and call a model once per Arrow batch:
    ``call(prompts)`` returns one dict per prompt with ``response`` and optionally
    ``prompt_tokens`` and ``completion_tokens``.

    Empty text is skipped. A failing call is data (``batch_call``). Hazards are parsed from the
    replies natively. ``template`` defaults to ``hazard_extraction``; it must hold ``{{placeholder}}``.
    """
    prompt = render_prompt(template or template_text("hazard_extraction"), {placeholder: F.col(text)})
    replies = batch_call(df, key, prompt, F.coalesce(F.trim(text), F.lit("")) != "", call)
    hazards = parse_hazard_array("reply")
    return replies.select(
        key,
        F.to_json(hazards).alias("extracted_hazards"),
        "status",
        "latency",
        "prompt_tokens",
        "completion_tokens",
        F.size(hazards).alias("num_hazards"),
        "error",
    )


def make_enrichment_udf(call: Callable[[list[str]], list[str]]):
    """A pandas UDF text -> reply text around a batch callable."""

    @F.pandas_udf("string")
    def enrich(texts: pd.Series) -> pd.Series:
        return pd.Series(call(texts.fillna("").tolist()))

    return enrich


def extraction_summary(df: DataFrame) -> DataFrame:
    """Figures of an extraction; latency over the rows that were asked (null elsewhere)."""
    total = F.count(F.lit(1))
    tokens = F.coalesce("prompt_tokens", F.lit(0)) + F.coalesce("completion_tokens", F.lit(0))
    return df.agg(
        total.alias("total"),
        F.count_if(F.col("status") == "success").alias("successes"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.sum(tokens).alias("total_tokens"),
        F.try_divide(F.sum(tokens), total).alias("avg_tokens"),
        F.sum("num_hazards").alias("hazards"),
        F.coalesce(F.sum("latency"), F.lit(0.0)).alias("total_latency"),
        F.avg("latency").alias("avg_latency"),
    )


# -------------------------------------------------------------------- judging


def judge_rows(df: DataFrame, extracted: str, reply: str) -> DataFrame:
    """Judge score and reason per row: an unreadable prediction or reply scores 0."""
    prediction_ok = F.try_parse_json(F.col(extracted)).isNotNull()
    reply_ok = F.try_parse_json(F.col(reply)).isNotNull()
    score = F.coalesce(F.get_json_object(reply, "$.score").try_cast("double"), F.lit(0.0))
    reason = F.coalesce(F.get_json_object(reply, "$.reasoning"), F.lit("no reason given"))
    return df.withColumn(
        "judge_score", F.when(prediction_ok & reply_ok, score).otherwise(F.lit(0.0))
    ).withColumn(
        "judge_reason",
        F.when(~prediction_ok, "prediction is not JSON")
        .when(~reply_ok, "judge reply is not JSON")
        .otherwise(reason),
    )


def judge_batch(
    df: DataFrame, source: str, extracted: str, call: Callable[[list[str]], list[dict]], key: str,
    template: str | None = None,
) -> DataFrame:
    """``key, judge_score, judge_reason``: the judge is called once per Arrow batch with the filled
    template. A prediction that is not JSON is not sent and scores 0, like a reply that is not."""
    prompt = render_prompt(
        template or template_text("extraction_judge"),
        {"source_text": F.col(source), "extracted_json": F.col(extracted)})
    ok = F.col(extracted).isNotNull() & F.try_parse_json(F.col(extracted)).isNotNull()
    asked = df.withColumn("__sent", ok)
    replies = batch_call(asked, key, prompt, F.col("__sent"), call)
    sent = F.when(F.col("status") != "skipped", F.lit("[]")).otherwise(F.lit("[{"))
    reply = F.when(F.col("status") == "success", F.col("reply"))
    return judge_rows(replies.select(key, sent.alias("__sent"), reply.alias("__reply")), "__sent", "__reply").select(
        key, "judge_score", "judge_reason")


def audit(
    df: DataFrame, source: str, extracted: str, call: Callable[[list[str]], list[dict]], key: str,
    percent: int = 5, seed: int = 42, below: float = QUARANTINE_BELOW,
) -> DataFrame:
    """Audit of an extraction: a repeatable sample, judged in batches, with the score on the 1..5
    scale of the quarantine limit. ``key, judge_score, score, judge_reason, quarantined``."""
    from terrahaz.operators.aggregate import audit_sample

    judged = judge_batch(audit_sample(df, key, percent, seed), source, extracted, call, key)
    scaled = judged.withColumn("score", to_five_point("judge_score"))
    return scaled.select(key, "judge_score", "score", "judge_reason", (F.col("score") < below).alias("quarantined"))


def judge_summary(df: DataFrame, score: str, below: float = QUARANTINE_BELOW) -> DataFrame:
    return df.agg(
        F.avg(score).alias("mean_score"),
        F.count(score).alias("evaluated"),
        F.count_if(F.col(score) < below).alias("below_threshold"),
    )


def to_five_point(score) -> Column:
    """A 0..1 score on the 1..5 scale the quarantine limit is stated in."""
    return F.lit(1.0) + F.lit(4.0) * _col(score)


def words(text) -> Column:
    """Distinct lower-case words of a text."""
    plain = F.regexp_replace(F.lower(F.coalesce(_col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.array_distinct(F.filter(F.split(plain, " "), lambda w: w != ""))


def faithfulness(source, claim) -> Column:
    """Share of the claim's words found in the source, and the words that are not."""
    have, said = words(source), words(claim)
    unsupported = F.sort_array(F.array_except(said, have))
    share = F.try_divide((F.size(said) - F.size(unsupported)).cast("double"), F.size(said))
    return F.struct(share.alias("faithfulness_score"), unsupported.alias("unsupported_claims"))


def extraction_checks(source, reply) -> Column:
    """What a judge looks for besides accuracy: ``valid_json`` (the reply is a JSON array),
    ``complete`` (every hazard has the required fields filled), ``faithfulness_score`` and
    ``unsupported_claims`` of all descriptions, and ``is_accurate``, all three together."""
    reply = _col(reply)
    valid = F.coalesce(F.trim(reply).startswith("[") & F.try_parse_json(reply).isNotNull(), F.lit(False))
    hazards = parse_hazard_array(reply)

    def filled(h) -> Column:
        full = F.lit(True)
        for field in REQUIRED_FIELDS:
            full = full & (F.coalesce(F.trim(h[field]), F.lit("")) != "")
        return full

    complete = valid & F.forall(hazards, filled)
    said = F.array_join(F.transform(hazards, lambda h: F.coalesce(h["description"], F.lit(""))), " ")
    faith = faithfulness(source, said)
    none_wrong = F.size(faith["unsupported_claims"]) == 0
    return F.struct(
        valid.alias("valid_json"), complete.alias("complete"), faith["faithfulness_score"].alias("faithfulness_score"),
        faith["unsupported_claims"].alias("unsupported_claims"), (complete & none_wrong).alias("is_accurate"))


def label_eval(predictions: DataFrame, labels: DataFrame, key: str, category: str) -> DataFrame:
    """Predictions against labels, per category: both sides are reduced to one aggregate."""
    from terrahaz.operators.aggregate import classification_metrics

    joined = predictions.join(labels, key)
    return classification_metrics(joined, "label", "prediction", [category])
