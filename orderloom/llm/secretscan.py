"""Secret scans over an incremental blob ledger (operator 10), DataFrame
functions only.

Every text is content-addressed by its SHA-256.  The ledger keeps, for each
blob, the rule versions it was scanned with and the spans found; a scan looks
only at (blob, rule version) pairs that the ledger has not seen, appends what
it finds, and joins the findings back to every path (row) of the blob.

Rules ``assign``, ``access`` and ``hex`` are fixed by the contract; ``pem``
and ``bearer`` are added.  Matches are leftmost and do not overlap per rule,
matches that fail the length test are dropped after matching.  Spans count
code points, end exclusive.

Defined cases: null and empty texts are one blob without findings; repeated
rows and copies share a blob; paths with a null id get their findings too;
an empty table scans nothing; the ledger may be missing, empty or hold other
versions of rules.  Other columns of the documents stay, whatever their
names; one named like the added column is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import common as C
from orderloom.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A pattern; the text of ``group`` must have ``least`` code points."""

    name: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# Fixed by the contract.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)
ADDED = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("bearer", 1, r"Bearer\x20+[A-Za-z0-9._~+/-]+=*", 0, 27),
)
RULES = BASE + ADDED

SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"
LEDGER = f"blob string, rules array<string>, spans {SPAN}"


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule in order.

    The pieces between matches and the matches themselves tell where each
    match starts.  Runs of one class of characters cannot hold a longer run,
    so a rule on its whole match may ask for the length in its pattern.
    """
    pattern = rule.pattern
    if rule.group == 0 and pattern.endswith("]+") and rule.least > 1:
        fixed = len(pattern.rpartition("[")[0])  # literal characters before the class
        pattern = f"{pattern[:-1]}{{{rule.least - fixed},}}"
    p = F.lit(pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    inner = F.regexp_extract_all(text, p, F.lit(rule.group)) if rule.group else found
    pieces = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(a: Column, m: Column) -> Column:
        begin = a["at"] + F.length(m["p"])
        end = begin + F.length(m["f"])
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.name).alias("kind"),
                        end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.length(m["i"]) >= rule.least, F.concat(a["out"], F.array(span)))
                        .otherwise(a["out"]).alias("out"))

    listed = F.arrays_zip(found.alias("f"), inner.alias("i"), F.slice(pieces, F.lit(1), F.size(found)).alias("p"))
    return F.when(F.size(found) > 0, F.aggregate(listed, start, step, lambda a: a["out"])).otherwise(
        F.array().cast(SPAN))


def scan_new(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows for the (blob, rule version) pairs not in ``ledger`` yet;
    ``blobs`` (blob, text) has a row for each blob."""
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    keys = F.array(*[F.lit(r.key) for r in rules])
    todo = (blobs.join(seen, "blob", "left")
            .withColumn("rules", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))))
            .where(F.size("rules") > 0))
    found = [F.when(F.array_contains("rules", r.key), spans_of(F.col("text"), r, k)).otherwise(
        F.array().cast(SPAN)) for k, r in enumerate(rules)]
    return todo.select("blob", "rules", F.concat(*found).alias("spans"))


def scan(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
         out_col: str = "spans") -> DataFrame:
    """``docs`` with the spans of their blob under ``rules`` in ``out_col``,
    sorted by start and rule; unseen pairs are scanned and added to the ledger
    (by default a new one under the shared folder)."""
    spark = docs.sparkSession
    path = ledger_path or scratch_path(spark, "secret-ledger")
    own, names = C.apart(docs)
    text = F.coalesce(F.col(names[text_col]), F.lit(""))
    addressed = own.withColumn("__blob", F.sha2(text.cast("binary"), 256))
    blobs = addressed.select(F.col("__blob").alias("blob"), text.alias("text")).groupBy("blob").agg(
        F.first("text").alias("text"))
    # The ledger's files are added in one commit: a failed scan adds none.
    # The schema's own empty part lets a new ledger be read.
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(path)
    scan_new(blobs, spark.read.schema(LEDGER).parquet(path), rules).write.mode("append").parquet(path)
    wanted = F.array(*[F.lit(r.name) for r in rules])
    asked = F.array(*[F.lit(r.key) for r in rules])
    known = spark.read.schema(LEDGER).parquet(path).where(F.size("spans") > 0)
    # A ledger row of several rules may hold other versions: keep ours.
    kinds = F.transform(F.array_intersect("rules", asked), lambda k: F.substring_index(k, "@", 1))
    asked_spans = F.filter("spans", lambda s: F.array_contains(kinds, s["kind"]))
    ranked = F.transform(asked_spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(wanted, s["kind"]).cast("int").alias("rank"),
        s["kind"].alias("kind"), s["end"].alias("end")))
    findings = known.select(F.col("blob").alias("__found"), ranked.alias("s")).groupBy("__found").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("s")))).alias("__spans")).where(F.size("__spans") > 0)
    findings = C.stored(findings, "secret-findings")
    joined = addressed.join(findings, F.col("__blob") == F.col("__found"), "left")
    return C.with_added(joined, names, {out_col: F.coalesce("__spans", F.array().cast(SPAN))})


def listing(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str) -> Column:
    return F.filter("found", lambda s: s["kind"] == kind)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, out_col="found").select("doc_id", "found")
    base = F.filter("found", lambda s: s["kind"].isin(*[r.name for r in BASE]))
    return found.select(
        "doc_id", *[F.size(_of_kind(r.name)).cast("long").alias(f"n_{r.name}") for r in BASE],
        F.sha2(listing(base).cast("binary"), 256).alias("base_sha256"), listing(F.col("found")).alias("spans"))


QUERIES = {"op10_secrets": op10_secrets}


def _oracle() -> str:
    """Spans from the matches and the pieces between them."""
    parts = []
    for k, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""SELECT doc_id, {k} AS rank, '{r.name}' AS kind, unnest(list_transform(
            generate_series(1, len(f)), lambda i: {{'s': list_sum(list_transform(p[1:i], lambda x: length(x)))
              + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0), 'n': length(f[i]),
              'g': length(g[i])}})) AS m, {r.least} AS least
            FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS f, regexp_extract_all(t, '{p}', {r.group}) AS g,
                         string_split_regex(t, '{p}') AS p FROM d) WHERE len(f) > 0""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(parts)}),
s AS (SELECT doc_id, rank, kind, CAST(m.s AS BIGINT) AS a, CAST(m.s + m.n AS BIGINT) AS z FROM m WHERE m.g >= least)
SELECT d.doc_id, count(*) FILTER (s.kind = 'assign') AS n_assign, count(*) FILTER (s.kind = 'access') AS n_access,
  count(*) FILTER (s.kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(s.kind || ':' || s.a || ':' || s.z, ',' ORDER BY s.a, s.rank)
                  FILTER (s.rank < {len(BASE)}), '')) AS base_sha256,
  coalesce(string_agg(s.kind || ':' || s.a || ':' || s.z, ',' ORDER BY s.a, s.rank), '') AS spans
FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
"""


ORACLES = {"op10_secrets": _oracle()}
