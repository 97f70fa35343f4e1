"""Secret scans with multipart credential linking, in DataFrame operations only.

Every kind of span is found by its pattern, leftmost and non-overlapping; a
span's place follows from the lengths of the pieces between the matches. The
parts of a credential that are too weak alone (an unlabelled key, a user
name, an endpoint) are linked to the parts that complete them by an interval
join per document: windows find the gap to the part before and to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import pin

# Kinds and patterns of the base spans (group `value` must have `least` characters).
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 20),
    ("hex", r"([0-9a-f]{24,})", 1, 24),  # runs are maximal, so shorter ones can be skipped at once
)
# Parts that count only beside a part that completes them.
WEAK = (
    ("weak_id", r"""(?i:user_?name|user|login|client_?id|account_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 1, 3),
    ("weak_key", r"([A-Za-z0-9+/_-]{32,})", 1, 32),
    ("endpoint", r"""([A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D"'<>]+)""", 1, 8),
)
KINDS = tuple(k for k, *_ in BASE + WEAK)
IDS, KEYS, ENDPOINT = ("access", "weak_id"), ("assign", "hex", "weak_key"), "endpoint"
# Which documents may hold a span at all: one cheap search instead of six scans.
SIGNS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": r"AKIA[A-Z0-9]",
    "hex": r"[0-9a-f]{24}",
    "weak": r"[A-Za-z0-9+/_-]{32}",
}


def _spans(text: F.Column, kind: str, pattern: str, group: int) -> F.Column:
    """Matches as an array of (piece before, match, value)."""
    return F.when(text.rlike(pattern), F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value")))


def find_parts(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, k (index of the kind), start, end (code points), value: every base and weak span by itself."""
    out = None
    for k, (kind, pattern, group, least) in enumerate(BASE + WEAK):
        rows = texts.select(*keys, F.posexplode(_spans(F.col("text"), kind, pattern, group)).alias("n", "m"))
        upto = Window.partitionBy(*keys).orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        end = F.sum(F.length("m.piece") + F.coalesce(F.length("m.hit"), F.lit(0))).over(upto)
        rows = rows.withColumn("end", end).where("m.hit IS NOT NULL").where(F.length("m.value") >= least)
        if kind == "weak_key":
            rows = rows.where(F.col("m.value").rlike("[A-Z]") & F.col("m.value").rlike("[a-z]") & F.col("m.value").rlike("[0-9]"))
        rows = rows.select(*keys, F.lit(k).alias("k"), (F.col("end") - F.length("m.hit")).alias("start"), "end")
        out = rows if out is None else out.unionByName(rows)
    return out


def link_parts(parts: DataFrame, keys: list[str], scope: int) -> DataFrame:
    """Base spans, and the weak ones that a complementary part completes at a gap of ``scope`` code points or less.

    A weak key needs an identifier, a weak identifier needs a key, an
    endpoint needs both. Weak spans inside a base span say nothing new and go.
    """
    is_in = lambda names: F.col("k").isin([KINDS.index(x) for x in names])
    by = Window.partitionBy(*keys).orderBy("start")
    there = by.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(*keys).orderBy("start").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    base = F.col("k") < len(BASE)
    tagged = parts.withColumn("inside", ~base & (F.coalesce(F.max(F.when(base, F.col("end"))).over(there), F.lit(0)) >= F.col("end")))
    tagged = tagged.where(~F.col("inside"))
    for name, side in (("ids", IDS), ("secrets", KEYS)):  # the gap from the end of the farther-reaching part before, or to the start of the next
        back = F.col("start") - F.max(F.when(is_in(side), F.col("end"))).over(there)
        on = F.min(F.when(is_in(side), F.col("start"))).over(ahead) - F.col("end")
        tagged = tagged.withColumn(name, (F.coalesce(F.least(back, on), F.lit(scope + 1)) <= scope).cast("int"))
    kind = lambda x: F.col("k") == KINDS.index(x)
    return tagged.where(base | (kind("weak_key") & (F.col("ids") == 1)) | (kind("weak_id") & (F.col("secrets") == 1))
                        | (kind("endpoint") & (F.col("ids") == 1) & (F.col("secrets") == 1))).select(*keys, "k", "start", "end")


def _joined(spans: F.Column) -> F.Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["start"], x["end"])), ",")


def secret_spans(docs: DataFrame, scope: int = 200) -> DataFrame:
    """One row per input row: doc_id, has (may hold spans), text_hash, spans array<struct<start,k,end>> by start, then kind.

    The result depends on the text alone, so rows are keyed by (doc_id, hash
    of the text); repeated rows meet the same spans. Null texts are empty; a
    null doc_id is an id like any other. Only texts that show a sign of a
    secret are kept for the scan.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sign = F.lit(False)
    for pattern in SIGNS.values():
        sign = sign | text.rlike(pattern)
    seen = docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn("has", sign)
    seen = pin(seen.select("doc_id", "has", F.when(F.col("has"), F.sha2("text", 256)).alias("text_hash"),
                           F.when(F.col("has"), F.col("text")).alias("text")))
    keys = ["doc_id", "text_hash"]
    texts = seen.where("has").dropDuplicates(keys)
    linked = link_parts(find_parts(texts, keys), keys, scope)
    found = linked.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start", "k", "end"))).alias("spans"))
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    return seen.drop("text").join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")),
                                  "left").select("doc_id", "text_hash", F.coalesce(
                                      "spans", F.array().cast("array<struct<start:bigint,k:int,end:bigint>>")).alias("spans"))


def scan_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """Secrets per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    In: doc_id and text (other columns are ignored), one output row per input
    row. ``spans`` lists kind:start:end (code points, end exclusive) of base
    and linked spans by start, then kind; ``base_sha256`` digests the base
    ones alone. Null and empty texts have no spans; an empty table no rows.
    """
    rows = secret_spans(docs, scope)
    base = F.filter("spans", lambda x: x["k"] < len(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["k"] == KINDS.index(kind))).cast("long")
    return rows.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                       F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
                       (F.size("spans") - F.size(base)).cast("long").alias("n_linked"))


def redact(docs: DataFrame, mark: str = "[secret]", scope: int = 200) -> DataFrame:
    """docs, all rows and columns, with every span of secrets in ``text`` replaced by ``mark``.

    Overlapping spans become one mark. ``n_chars`` is counted anew for
    changed texts, if there is such a column. Null texts stay null.
    """
    rows = secret_spans(docs.select("doc_id", "text"), scope).where(F.size("spans") > 0).distinct()
    at = rows.select("doc_id", "text_hash", F.inline("spans"))
    key = ["doc_id", "text_hash"]
    by = Window.partitionBy(*key).orderBy("start", "end")
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    at = at.withColumn("new", (F.coalesce(before, F.lit(-1)) < F.col("start")).cast("int"))
    at = at.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    at = at.groupBy(*key, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    start = F.coalesce(F.lag("end").over(Window.partitionBy(*key).orderBy("start")), F.lit(0))
    cut = at.withColumn("from", start).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("from", "start"))).alias("keep"), F.max("end").alias("last"))
    cut = cut.select(*[F.col(c).alias(f"__{c}") for c in ("doc_id", "text_hash", "keep", "last")])
    sign = F.lit(False)
    for pattern in SIGNS.values():
        sign = sign | F.coalesce(F.col("text").rlike(pattern), F.lit(False))
    hashed = docs.withColumn("__sha", F.when(sign, F.sha2(F.col("text").cast("string"), 256)))
    got = hashed.join(cut, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__sha") == F.col("__text_hash")), "left")
    pieces = F.transform("__keep", lambda x: F.substring(F.col("text"), (x["from"] + 1).cast("int"), (x["start"] - x["from"]).cast("int")))
    clean = F.concat(F.concat_ws(mark, pieces), F.lit(mark), F.expr("substring(text, int(__last + 1))"))
    new = {"text": F.when(F.col("__keep").isNotNull(), clean).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__keep").isNotNull(), F.length(clean).cast("long")).otherwise(F.col("n_chars"))
    return got.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
