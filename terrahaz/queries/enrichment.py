"""Model replies: parsing, prompts, extraction, judging."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrahaz.operators import enrich as E
from terrahaz.queries import views as V
from terrahaz.queries.registry import query
from terrahaz.queries.rollups import hash_sql
from terrahaz.session import scratch
from terrahaz.sources import sinks

_SEVERITY = "try_cast(CASE WHEN json_valid(reply) THEN json_extract_string(reply,'$.severity') END AS double)"


@query(
    "parse_ai_enrichment",
    f"""SELECT reply_id, cast(CASE WHEN {_SEVERITY} IS NULL THEN 5 ELSE trunc(least(greatest({_SEVERITY},1),10)) END as int) AS ai_severity,
    coalesce(CASE WHEN json_valid(reply) THEN json_extract_string(reply,'$.hazard_type') END,'unknown') AS ai_hazard_type FROM fx_replies""",
)
def parse_ai_enrichment(spark, sf):
    df = V.view(spark, sf, "fx_replies").withColumn("p", E.parse_ai_enrichment("reply"))
    return df.select("reply_id", "p.ai_severity", "p.ai_hazard_type")


V.SQL_VIEWS["fx_hazards"] = """SELECT reply_id, CASE reply_id%8 WHEN 0 THEN [{'t':'weather','d':'d'||reply_id,'s':'high','l':NULL,'w':NULL}]
 WHEN 1 THEN [{'t':'fire','d':'x'||reply_id,'s':'low','l':NULL,'w':NULL},{'t':'crime','d':'y','s':'low','l':NULL,'w':NULL}]
 WHEN 7 THEN [{'t':'medical','d':'m','s':'medium','l':'gate 3','w':'09:30'},{'t':'weather','d':'w','s':'low','l':NULL,'w':NULL}] ELSE [] END AS h FROM fx_replies"""


@query(
    "parse_hazard_array",
    "SELECT reply_id, len(h) AS num_hazards, CASE WHEN len(h)>0 THEN h[1].t END AS first_type FROM fx_hazards",
)
def parse_hazard_array(spark, sf):
    h = E.parse_hazard_array("array_reply")
    df = V.view(spark, sf, "fx_replies").withColumn("h", h)
    return df.select("reply_id", F.size("h").cast("bigint").alias("num_hazards"), F.get("h", 0)["hazard_type"].alias("first_type"))


@query(
    "explode_hazards",
    """SELECT reply_id, len(h) AS num_hazards, e.t AS hazard_type, e.d AS description, e.s AS severity,
    e.l AS location, e.w AS timestamp FROM
    (SELECT reply_id, h, unnest(CASE WHEN len(h)=0 THEN [NULL] ELSE h END) AS e FROM fx_hazards)""",
)
def explode_hazards(spark, sf):
    df = V.view(spark, sf, "fx_replies").select("reply_id", E.parse_hazard_array("array_reply").alias("h"))
    return E.explode_hazards(df, "h").withColumn("num_hazards", F.col("num_hazards").cast("bigint"))


def _template_sql(name: str, values: dict[str, str]) -> str:
    text = "'" + E.template_text(name).replace("'", "''") + "'"
    for key, column in values.items():
        text = f"replace({text}, '{{{{{key}}}}}', coalesce({column},''))"
    return text


@query(
    "render_prompt",
    f"SELECT doc_id, sha256({_template_sql('hazard_extraction', {'input_text': 'text'})}) AS prompt_digest FROM documents",
)
def render_prompt(spark, sf):
    prompt = E.render_prompt(E.template_text("hazard_extraction"), {"input_text": F.col("text")})
    return V.table(spark, sf, "documents").select("doc_id", F.sha2(prompt, 256).alias("prompt_digest"))


def _extract_sql() -> str:
    parts = []
    for kind, words in E.KEYWORD_HAZARDS.items():
        hit = "|".join(words)
        parts.append(f"(regexp_matches(lower(text),'{hit}'))::bigint")
    return "+".join(parts)


_EXTRACT = f"""SELECT doc_id, CASE WHEN trim(coalesce(text,''))='' THEN 'skipped' ELSE 'success' END AS status, {_extract_sql()} AS num_hazards FROM
 (SELECT doc_id, text FROM documents UNION ALL SELECT 1000000+reply_id, reply FROM fx_replies)"""


def _texts(spark, sf):
    documents = V.table(spark, sf, "documents").select("doc_id", "text")
    replies = V.view(spark, sf, "fx_replies").selectExpr("1000000+reply_id AS doc_id", "reply AS text")
    return documents.unionByName(replies)


@query("extract_native", _EXTRACT.replace(_extract_sql(), f"coalesce({_extract_sql()},0)"))
def extract_native(spark, sf):
    rows = E.extract_native(_texts(spark, sf), "text")
    return rows.select("doc_id", "status", F.col("num_hazards").cast("bigint").alias("num_hazards"))


@query("batch_extract", _EXTRACT.replace(_extract_sql(), f"coalesce({_extract_sql()},0)"))
def batch_extract(spark, sf):
    """The batched model call, with a keyword model standing in for the server."""
    table = dict(E.KEYWORD_HAZARDS)

    def call(prompts):
        import json

        answers = []
        for prompt in prompts:
            low = prompt.partition("Report:\n")[2].lower()
            found = [{"hazard_type": k, "description": k, "severity": "medium"} for k, ws in table.items() if any(w in low for w in ws)]
            answers.append({"response": json.dumps(found), "prompt_tokens": len(low.split())})
        return answers

    rows = E.batch_extract(_texts(spark, sf), "text", call, "doc_id")
    return rows.select("doc_id", "status", F.col("num_hazards").cast("bigint").alias("num_hazards"))


def _words(column: str) -> str:
    return f"list_distinct(list_filter(string_split(regexp_replace(lower(coalesce({column},'')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'),' '), lambda x: x<>''))"


@query(
    "extraction_checks",
    f"""WITH p AS (SELECT reply_id, 'd'||reply_id||' Y; m and W' AS src, array_reply AS r, h, coalesce(array_reply LIKE '[%', false) AS ok,
    array_to_string(list_transform(h, lambda x: x.d),' ') AS claim FROM fx_replies JOIN fx_hazards USING (reply_id)),
    q AS (SELECT *, {_words('claim')} AS said, {_words('src')} AS have FROM p)
    SELECT reply_id, ok AS valid_json, ok AS complete,
    CASE WHEN len(said)>0 THEN len(list_filter(said, lambda x: list_contains(have,x)))::double/len(said) END AS faithfulness_score,
    ok AND len(list_filter(said, lambda x: NOT list_contains(have,x)))=0 AS is_accurate FROM q""",
)
def extraction_checks(spark, sf):
    source = F.concat(F.lit("d"), F.col("reply_id").cast("string"), F.lit(" Y; m and W"))
    df = V.view(spark, sf, "fx_replies").withColumn("c", E.extraction_checks(source, "array_reply"))
    return df.select("reply_id", "c.valid_json", "c.complete", "c.faithfulness_score", "c.is_accurate")


def _judge(prompts):
    """A stand-in judge: trusts an extraction by the length of what it was made from."""
    answers = []
    for prompt in prompts:
        text = prompt.partition("Text:\n")[2].rpartition("\n\nExtraction:\n")[0]
        n = len(text)
        score = "soon" if n % 7 == 0 else f"{n % 11 / 10}"
        reply = f'{{"score": {score}, "reasoning": "{n} characters"}}'
        answers.append({"response": reply})
    return answers


_AUDITED = f"""WITH s AS (SELECT doc_id, length(coalesce(text,'')) AS n FROM documents WHERE {hash_sql('doc_id')}%100<5),
 j AS (SELECT doc_id, CASE WHEN n%7=0 THEN 0 ELSE (n%11)/10 END AS judge_score,
 CASE WHEN n%7=0 THEN 'judge reply is not JSON' ELSE n||' characters' END AS judge_reason FROM s),
 a AS (SELECT *, round(1+4*judge_score,6) AS score FROM j)"""


def _audited(spark, sf):
    """Extract, sample, judge, scale, write both sides in one pass and read them back."""
    texts = V.table(spark, sf, "documents").select("doc_id", "text")
    extracted = E.extract_native(texts, "text").select("doc_id", "text", "extracted_hazards")
    path = scratch(spark, "audit")
    sinks.write_quarantine(E.audit(extracted, "text", "extracted_hazards", _judge, "doc_id"), path, "score")
    return spark.read.parquet(path)


@query(
    "audit_flow",
    f"""{_AUDITED} SELECT doc_id, cast(judge_score as double) AS judge_score, score, judge_reason,
    CASE WHEN score<3 THEN 'quarantined' ELSE 'passed' END AS verdict FROM a""",
)
def audit_flow(spark, sf):
    return _audited(spark, sf).select("doc_id", "judge_score", F.round("score", 6).alias("score"), "judge_reason", "verdict")


@query(
    "audit_summary",
    f"{_AUDITED} SELECT round(avg(score),6) AS mean_score, count(*) AS evaluated, count(*) FILTER (score<3) AS below_threshold FROM a",
)
def audit_summary(spark, sf):
    return E.judge_summary(_audited(spark, sf), "score").withColumn("mean_score", F.round("mean_score", 6))


@query("enrichment_udf", "SELECT doc_id, '{\"severity\": '||(1+length(text)%10)||'}' AS reply FROM documents")
def enrichment_udf(spark, sf):
    udf = E.make_enrichment_udf(lambda texts: [f'{{"severity": {1 + len(t) % 10}}}' for t in texts])
    return V.table(spark, sf, "documents").select("doc_id", udf("text").alias("reply"))


@query(
    "token_usage",
    """SELECT reply_id, coalesce(prompt_tokens,0) AS prompt_tokens, coalesce(completion_tokens,0) AS completion_tokens,
    coalesce(prompt_tokens,0)+coalesce(completion_tokens,0) AS total_tokens FROM fx_replies""",
)
def token_usage(spark, sf):
    df = V.view(spark, sf, "fx_replies").withColumn("u", E.token_usage("prompt_tokens", "completion_tokens"))
    return df.select("reply_id", "u.prompt_tokens", "u.completion_tokens", "u.total_tokens")


@query(
    "parse_judge_score",
    """SELECT reply_id, coalesce(try_cast(nullif(regexp_extract(coalesce(judge_reply,''), '"score"\\s*:\\s*([0-9.]+)', 1),'') AS double), 0.5) AS score FROM fx_replies""",
)
def parse_judge_score(spark, sf):
    return V.view(spark, sf, "fx_replies").select("reply_id", E.parse_judge_score("judge_reply").alias("score"))


@query(
    "judge_rows",
    """SELECT reply_id, CASE WHEN NOT extracted_ok OR NOT coalesce(json_valid(judge_reply),false) THEN 0.0::double
    ELSE coalesce(try_cast(json_extract_string(judge_reply,'$.score') AS double),0.0::double) END AS judge_score,
    CASE WHEN NOT extracted_ok THEN 'prediction is not JSON' WHEN NOT coalesce(json_valid(judge_reply),false) THEN 'judge reply is not JSON'
    ELSE coalesce(json_extract_string(judge_reply,'$.reasoning'),'no reason given') END AS judge_reason FROM fx_replies""",
)
def judge_rows(spark, sf):
    df = V.view(spark, sf, "fx_replies").withColumn("extracted", F.when(F.col("extracted_ok"), "[]").otherwise("[{"))
    return E.judge_rows(df, "extracted", "judge_reply").select("reply_id", "judge_score", "judge_reason")


@query(
    "faithfulness",
    f"""WITH p AS (SELECT a.conv_id AS conv_id, a.turn AS turn, {_words('b.text')} AS said, {_words('a.text')} AS have FROM conversations a JOIN conversations b
    ON b.conv_id=a.conv_id AND b.turn=a.turn+1 WHERE b.role='assistant')
    SELECT conv_id, turn, CASE WHEN len(said)=0 THEN NULL ELSE len(list_filter(said, lambda x: list_contains(have,x)))::double/len(said) END AS score,
    len(list_filter(said, lambda x: NOT list_contains(have,x))) AS unsupported FROM p""",
)
def faithfulness(spark, sf):
    """Is each assistant turn supported by the turn before it?"""
    turns = V.table(spark, sf, "conversations")
    before = turns.select("conv_id", "turn", F.col("text").alias("source"))
    after = turns.where("role='assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("claim"))
    df = before.join(after, ["conv_id", "turn"]).withColumn("f", E.faithfulness("source", "claim"))
    return df.select(
        "conv_id", "turn", F.col("f.faithfulness_score").alias("score"), F.size("f.unsupported_claims").cast("bigint").alias("unsupported")
    )


@query(
    "final_severity",
    f"""SELECT reply_id, cast(least(greatest(round(coalesce(CASE lower(CASE WHEN json_valid(reply) THEN json_extract_string(reply,'$.severity') END) WHEN 'high' THEN 8
    ELSE {_SEVERITY} END, source_severity, 5)),1),10) as int) AS final_severity FROM fx_replies""",
)
def final_severity(spark, sf):
    df = V.view(spark, sf, "fx_replies").withColumn("ai", F.get_json_object("reply", "$.severity"))
    return df.select("reply_id", E.final_severity("ai", "source_severity").alias("final_severity"))
