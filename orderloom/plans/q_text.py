"""Text, file-source and data-quality queries over documents / conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.functions import text as tx
from orderloom.operators import quality as dq
from orderloom.operators.joins import join_dimension
from orderloom.session import scratch_path
from orderloom.sources import files
from orderloom.sources.tables import load


def q_flatmap_words(spark, sf):
    c = load(spark, sf, "conversations")
    w = c.select(F.explode(tx.words("text")).alias("word"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))


def q_reverse_words(spark, sf):
    c = load(spark, sf, "conversations")
    return c.select("conv_id", "turn", tx.reverse_words("text").alias("reversed"))


def q_contact_rules(spark, sf):
    """Every mail address and every phone number of every text, one row each."""
    d = load(spark, sf, "documents")
    found = F.concat(
        F.transform(F.regexp_extract_all("text", F.lit(tx.MAIL), F.lit(0)),
                    lambda m: F.struct(m.alias("mail"), F.lit(None).cast("string").alias("phone"))),
        F.transform(F.regexp_extract_all("text", F.lit(tx.PHONE), F.lit(0)),
                    lambda p: F.struct(F.lit(None).cast("string").alias("mail"), p.alias("phone"))))
    c = d.select("doc_id", F.inline(found))
    name = F.substring_index("mail", "@", 1)
    return c.select("doc_id", name.alias("name"), tx.digits_only("phone").alias("phone_digits"), "mail",
                    tx.name_ok(name).alias("name_ok"), tx.phone_ok("phone").alias("phone_ok"),
                    tx.mail_ok("mail").alias("mail_ok"))


def q_text_line_count(spark, sf):
    path = scratch_path(spark, "documents-text")
    files.write_text(load(spark, sf, "documents"), "text", path)
    t = files.read_text(spark, path)
    return t.agg(F.count(F.lit(1)).alias("n_lines"),
                 F.count(F.when(F.col("value") != "", True)).alias("n_nonempty_lines"))


def _customer_with_note(spark, sf):
    c = load(spark, sf, "customer")
    return c.withColumn("c_note", F.concat(F.lit('say "'), F.col("c_mktsegment"), F.lit('", ok')))


def q_csv_roundtrip(spark, sf):
    src = _customer_with_note(spark, sf)
    path = scratch_path(spark, "customer-csv")
    files.write_csv(src, path)
    return files.read_csv(spark, path, schema=src.schema)


def q_csv_quarantine_rows(spark, sf):
    """Building-segment balances are written with a currency suffix, which
    does not parse as a double: those rows land in the quarantine side."""
    c = load(spark, sf, "customer")
    bal = F.when(F.col("c_mktsegment") == "BUILDING",
                 F.concat(F.col("c_acctbal").cast("string"), F.lit(" USD"))
                 ).otherwise(F.col("c_acctbal").cast("string"))
    raw = c.withColumn("c_acctbal", bal)
    path = scratch_path(spark, "customer-csv-bad")
    files.write_csv(raw, path)
    _good, bad = files.read_csv_checked(spark, path, c.schema)
    quarantine = scratch_path(spark, "customer-csv-quarantine")
    files.write_quarantine(bad, quarantine)          # error rows to their own files
    return spark.read.parquet(quarantine).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


def q_fill_missing(spark, sf):
    d = load(spark, sf, "documents").select("doc_id")
    lab = load(spark, sf, "labels").select("doc_id", "quality", "toxic")
    j = join_dimension(d, lab, "doc_id", "left")
    return j.na.fill(-1, ["quality", "toxic"])


# Document rules (not null, domain, consistency, minimum size).
LANGS = ["en", "fr", "de", "es"]
MIN_TEXT_CHARS = 50


def document_rules():
    t = F.col("text")
    return [
        ("text_present", t.isNotNull() & (F.length(t) > 0)),
        ("lang_known", F.col("lang").isin(LANGS)),
        ("length_matches", F.col("n_chars") == F.length(t)),
        ("source_present", F.col("source").isNotNull() & (F.col("source") != "")),
        ("min_text_length", F.length(t) >= MIN_TEXT_CHARS),
    ]


def _tagged(spark, sf):
    d = load(spark, sf, "documents")
    return dq.tag_rows(d, document_rules())


def q_dq_tag_rows(spark, sf):
    return _tagged(spark, sf).select("doc_id", F.array_join("failed_rule_id", ",").alias("failed_rules"))


def q_dq_quarantine(spark, sf):
    return dq.quarantined(_tagged(spark, sf)).select(
        "doc_id", "source", F.array_join("failed_rule_id", ",").alias("failed_rules"))


def q_dq_scorecard(spark, sf):
    return dq.scorecard(load(spark, sf, "documents"), document_rules())


def q_dq_constraints(spark, sf):
    conv = load(spark, sf, "conversations")
    docs = load(spark, sf, "documents")
    lab = load(spark, sf, "labels")
    checks = [
        ("unique_conversation_turn", dq.unique_violations(conv, ["conv_id", "turn"])),
        ("labels_doc_fk", dq.foreign_key_violations(lab, docs, "doc_id", "doc_id")),
        ("documents_text_not_null", docs.filter(F.col("text").isNull())),
        ("conversation_role_domain",
         conv.filter(~F.coalesce(F.col("role").isin(["user", "assistant", "system"]), F.lit(False)))),
    ]
    parts = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(n).alias("constraint_name"), "violations")
             for n, df in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES = {
    "flatmap_words": q_flatmap_words,
    "reverse_words": q_reverse_words,
    "contact_rules": q_contact_rules,
    "text_line_count": q_text_line_count,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_quarantine_rows": q_csv_quarantine_rows,
    "fill_missing": q_fill_missing,
    "dq_tag_rows": q_dq_tag_rows,
    "dq_quarantine": q_dq_quarantine,
    "dq_scorecard": q_dq_scorecard,
    "dq_constraints": q_dq_constraints,
}

_WS = r"'[ \t\n\r]+'"
_MAIL = r"'[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}'"
_PHONE = r"'[+]?[0-9][0-9 ()-]{8,}[0-9]'"
_RULES = """
  (text IS NOT NULL AND length(text) > 0) AS r1, lang IN ('en', 'fr', 'de', 'es') AS r2,
  n_chars = length(text) AS r3, (source IS NOT NULL AND source <> '') AS r4,
  length(text) >= 50 AS r5"""
_TAGS = """concat_ws(',', CASE WHEN COALESCE(r1, false) THEN NULL ELSE 'text_present' END,
  CASE WHEN COALESCE(r2, false) THEN NULL ELSE 'lang_known' END,
  CASE WHEN COALESCE(r3, false) THEN NULL ELSE 'length_matches' END,
  CASE WHEN COALESCE(r4, false) THEN NULL ELSE 'source_present' END,
  CASE WHEN COALESCE(r5, false) THEN NULL ELSE 'min_text_length' END)"""

ORACLES = {
    "flatmap_words": f"""SELECT word, count(*) AS occurrences FROM (
  SELECT unnest(regexp_split_to_array(text, {_WS})) AS word FROM conversations) WHERE word <> ''
GROUP BY word""",
    "reverse_words": f"""SELECT conv_id, turn,
  array_to_string(list_reverse(list_filter(regexp_split_to_array(text, {_WS}), lambda x: x <> '')), ' ') AS reversed
FROM conversations""",
    "contact_rules": f"""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, {_MAIL}, 0)) AS mail, NULL AS phone FROM documents
  UNION ALL SELECT doc_id, NULL, unnest(regexp_extract_all(text, {_PHONE}, 0)) FROM documents)
SELECT doc_id, split_part(mail, '@', 1) AS name, regexp_replace(phone, '[^0-9]', '', 'g') AS phone_digits, mail,
  length(split_part(mail, '@', 1)) > 5 AS name_ok,
  length(regexp_replace(phone, '[^0-9]', '', 'g')) = 10
    AND starts_with(regexp_replace(phone, '[^0-9]', '', 'g'), '9') AS phone_ok,
  regexp_matches(mail, '@[A-Za-z0-9.-]*mail[A-Za-z0-9.-]*[.]com$') AS mail_ok
FROM c""",
    "text_line_count": """SELECT sum(len(string_split(text, chr(10))))::BIGINT AS n_lines,
  sum(len(list_filter(string_split(text, chr(10)), lambda x: x <> '')))::BIGINT AS n_nonempty_lines
FROM documents""",
    "csv_roundtrip": """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  'say "' || c_mktsegment || '", ok' AS c_note FROM customer""",
    "csv_quarantine_rows": """SELECT c_custkey, c_name, c_mktsegment, CAST(NULL AS DOUBLE) AS c_acctbal
FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "fill_missing": """SELECT d.doc_id, COALESCE(l.quality, -1) AS quality, COALESCE(l.toxic, -1) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "dq_tag_rows": f"SELECT doc_id, {_TAGS} AS failed_rules FROM (SELECT doc_id, {_RULES} FROM documents)",
    "dq_quarantine": f"""SELECT doc_id, source, failed_rules FROM (
  SELECT doc_id, source, {_TAGS} AS failed_rules FROM (SELECT doc_id, source, {_RULES} FROM documents))
WHERE failed_rules <> ''""",
    "dq_scorecard": f"""WITH r AS (SELECT {_RULES} FROM documents), t AS (SELECT count(*) AS n,
  sum(COALESCE(r1, false)::INT) AS p1, sum(COALESCE(r2, false)::INT) AS p2, sum(COALESCE(r3, false)::INT) AS p3,
  sum(COALESCE(r4, false)::INT) AS p4, sum(COALESCE(r5, false)::INT) AS p5 FROM r)
SELECT rule_id, n AS total_rows, passed_rows::BIGINT AS passed_rows, round(passed_rows / n, 6) AS pass_rate FROM (
  SELECT 'text_present' AS rule_id, n, p1 AS passed_rows FROM t UNION ALL SELECT 'lang_known', n, p2 FROM t
  UNION ALL SELECT 'length_matches', n, p3 FROM t UNION ALL SELECT 'source_present', n, p4 FROM t
  UNION ALL SELECT 'min_text_length', n, p5 FROM t)""",
    "dq_constraints": """SELECT 'unique_conversation_turn' AS constraint_name, count(*) AS violations FROM (
  SELECT conv_id, turn FROM conversations GROUP BY conv_id, turn HAVING count(*) > 1)
UNION ALL SELECT 'labels_doc_fk', count(*) FROM labels l
  WHERE l.doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)
UNION ALL SELECT 'documents_text_not_null', count(*) FROM documents WHERE text IS NULL
UNION ALL SELECT 'conversation_role_domain', count(*) FROM conversations
  WHERE NOT COALESCE(role IN ('user', 'assistant', 'system'), false)""",
}
