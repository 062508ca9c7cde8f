"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed. Only pairs of a blob and a rule version that
the ledger has not seen are scanned; findings are joined back to all paths that hold the blob.
Everything is DataFrame code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homestat.llm.common import fresh_name, scratch, stored, table


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; matches whose ``group`` is shorter than
    ``least`` characters are dropped. Texts without any of ``needs`` have no match."""

    kind: str
    pattern: str
    least: int
    needs: tuple[str, ...]
    group: int = 0
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The three base kinds, in their order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, (":", "="), 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16, ("AKIA",)),
    # runs of 32 and more are found directly: no shorter run can hide a longer one
    Rule("hex", r"[0-9a-f]{32,}", 32, ()),
)
EXTRA = (
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]+=*", 27, ()),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", 40, ("gho_", "ghp_", "ghs_", "ghu_")),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", 32, ("eyJ",)),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27, ("PRIVATE KEY-----",)),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15, ("xox",)),
    # from the start of a run of letters only: any later start would match up to the same end
    Rule("urlauth", r"(?<![a-z])[a-z]++://[^\s/:@]++:[^\s/:@]++@", 8, ("://",)),
)
RULES = BASE + EXTRA
SPAN = "struct<start:int,rank:int,kind:string,end:int>"
LEDGER = f"blob binary, scanned array<string>, spans array<{SPAN}>"


STEPS = "array<struct<gap:int,size:int,good:boolean>>"


def steps(text: Column, rule: Rule) -> Column:
    """(gap before it, length, long enough) of the rule's matches, in order, in code points."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    gaps = F.split(text, rule.pattern, -1)
    # side by side first: inside a lambda the arrays would be made again for every match
    beside = F.arrays_zip(matches.alias("m"), judged.alias("j"), gaps.alias("g"))
    found = F.transform(F.filter(beside, lambda s: s["m"].isNotNull()), lambda s: F.struct(
        F.char_length(s["g"]).alias("gap"), F.char_length(s["m"]).alias("size"), (F.char_length(s["j"]) >= rule.least).alias("good")))
    candidate = text.rlike(rule.pattern)
    for k, need in enumerate(rule.needs):
        some = F.contains(text, F.lit(need)) if not k else some | F.contains(text, F.lit(need))
    if rule.needs:
        candidate = some & candidate
    return F.when(candidate, found).otherwise(F.array().cast(STEPS))


def located(stepped: DataFrame) -> DataFrame:
    """(blob, spans) of the good matches in ``stepped`` (blob, found: array of rank, kind, steps).

    A match starts where all gaps and matches of its rule before it end: a running sum over the
    matches of one blob and rule, so the work grows with the matches, not with their square.
    """
    of_rule = stepped.select("blob", F.explode("found").alias("f"))
    every = of_rule.select("blob", "f.rank", "f.kind", F.posexplode("f.steps").alias("i", "s"))
    so_far = Window.partitionBy("blob", "rank").orderBy("i")
    placed = every.withColumn("end", F.sum(F.col("s.gap") + F.col("s.size")).over(so_far).cast("int")).where("s.good")
    span = F.struct((F.col("end") - F.col("s.size")).alias("start"), "rank", "kind", "end")
    return placed.groupBy("blob").agg(F.array_sort(F.collect_list(span)).cast(f"array<{SPAN}>").alias("spans"))


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class Ledger:
    """Findings by blob, appended by every scan, in a shared folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or scratch(spark, "ledger")

    def empty(self) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return not fs.exists(folder) or not any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(folder))

    def rows(self) -> DataFrame:
        if self.empty():
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def ingest(self, versions: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
        """Scan the blobs of ``versions`` (any historical versions) for the rule versions they lack.

        Copies are folded in the map tasks, so a blob that a third of all rows hold is scanned
        once and shuffled once a task. A ledger with entries is asked for digests first, and only
        texts of blobs that lack a rule version are moved. The ledger holds digests and spans, never texts.
        """
        every = F.array(*[F.lit(r.key) for r in rules])
        texts = versions.select(blob_of(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        if self.empty():
            missing = texts.withColumn("scanned", every)
        else:
            # digests first: texts of blobs that lack no rule version are not moved
            known = self.rows().groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("seen"))
            lacking = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))).alias("scanned")
            todo = stored(texts.select("blob").distinct().join(known, "blob", "left").select("blob", lacking).where(F.size("scanned") > 0), "unseen")
            missing = texts.join(todo, "blob")
        blobs = missing.groupBy("blob").agg(F.first("text").alias("text"), F.first("scanned").alias("scanned"))
        none = F.array().cast(STEPS)
        found = F.filter(F.array(*[
            F.struct(F.lit(i).alias("rank"), F.lit(r.kind).alias("kind"),
                     F.when(F.array_contains("scanned", r.key), steps(F.col("text"), r)).otherwise(none).alias("steps"))
            for i, r in enumerate(rules)]), lambda f: F.size(f["steps"]) > 0)
        stepped = stored(blobs.select("blob", "scanned", found.alias("found")), "matches")
        spans = stored(located(stepped), "located")
        stepped.select("blob", "scanned").join(spans, "blob", "left").select(
            "blob", "scanned", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans")).write.mode("append").parquet(self.path)

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, spans) of blobs with findings of these rules, by start and then kind."""
        kinds = [r.kind for r in rules]
        every = self.rows().select("blob", F.explode("spans").alias("span")).where(F.col("span.kind").isin(kinds)).distinct()
        return every.groupBy("blob").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def scan(versions: DataFrame, ledger: Ledger | None = None, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` with a last column ``spans``: (start, rank, kind, end) of every secret.

    Positions are code points, end exclusive. A null text counts as empty and has no spans.
    Repeated rows each get their blob's spans. The column gets underscores if the name is taken.
    Kinds are append-only: a changed pattern takes a new version, and then its own kind.
    """
    spark = versions.sparkSession
    ledger = ledger or Ledger(spark)
    ledger.ingest(versions, text, rules)
    # written: with two plain tables in the join, Spark can split the rows of a hot blob
    found = stored(ledger.findings(rules), "findings")
    blob, name = fresh_name(versions, "_blob"), fresh_name(versions, "spans")
    keyed = versions.withColumn(blob, blob_of(F.col(text)))
    spans = F.coalesce(F.col("_found.spans"), F.array().cast(f"array<{SPAN}>"))
    return keyed.join(found.alias("_found"), keyed[blob] == F.col("_found.blob"), "left").select(
        *[keyed[c] for c in versions.columns], spans.alias(name))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents", ["doc_id", "text"]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return out.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(listed(base), 256).alias("base_sha256"),
                      listed(F.col("spans")).alias("spans"))
