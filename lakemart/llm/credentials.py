"""Secret scan with multipart credential linking.

Strong parts are reported wherever they stand: ``assign`` (a secret-like name with a value), ``access``
(access key identifiers) and ``hex`` (long hexadecimal runs). Weak parts are ordinary text on their
own: ``user`` (a login or client name), ``key`` (a bare 40-character token) and ``endpoint`` (an
address). A weak part is reported only where its complement stands within ``scope`` characters:

    user      needs a secret (assign or key)
    key       needs an identifier (access or user)
    endpoint  needs an identifier and a secret

The interval join is an as-of join both ways. Matches of one pattern do not overlap, so among those
that start before a part the last one also ends last, and among those that start after it the first is
nearest: these two decide whether any lies in scope. It is a running maximum over the sorted parts of
a document, linear however many parts there are.

All of it is DataFrame and SQL functions; the texts are read once and never shuffled.

Defined results: a null text is the empty text and has no parts; a very long text is scanned whole, its parts are
linked in one pass over them; each row is scanned for itself, so
repeated rows each give their spans and ties in position are ordered by kind; null ids are carried
along; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.llm.common import name_of, stored, text_of

# Name, pattern, what the text must hold for the pattern to match at all. The first three
# give the spans that are always reported. Hex and access runs are maximal, so a least length in the
# pattern finds the same spans as dropping the short runs afterwards; assign values are measured later.
KINDS = [
    ("assign", r"""(?=[pPsStTaA])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     ("=", ":")),
    ("access", r"AKIA[A-Z0-9]{14,}", ("AKIA",)),
    ("hex", r"[0-9a-f]{16,}", ()),
    ("user", r"""(?=[uUlLcC])(?i:user(?:name)?|login|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
     ("=", ":")),
    ("key", r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[A-Z])(?=[A-Za-z0-9+/]{0,39}[a-z])"
            r"[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])", ()),
    ("endpoint", r"""(?:https?|s3|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>]+""", ("://",)),
]
STRONG = ("assign", "access", "hex")
LEAST_VALUE = 12
IDENTIFIERS = ("access", "user")
SECRETS = ("assign", "key")
#: Characters between a weak part and its complement, at most.
SCOPE = 400


def _matches(text: Column, number: int, pattern: str, needs: tuple[str, ...]) -> Column:
    """Every match of one kind, in order: kind, i, gap (characters since the match before), long, good."""
    may = F.lit(True) if not needs else F.lit(False)
    for part in needs:
        may = may | F.contains(text, F.lit(part))
    hits = F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    # The pieces between the matches; there is one more than matches, which zip_with pairs with null.
    gaps = F.when(F.size(hits) > 0, F.split(text, pattern, -1))
    good = (lambda hit: F.length(F.regexp_extract(hit, pattern, 1)) >= LEAST_VALUE) if number == 0 else (lambda hit: F.lit(True))
    pairs = F.filter(
        F.zip_with(hits, gaps, lambda hit, gap: F.struct(
            F.length(gap).alias("gap"), F.length(hit).alias("long"), good(hit).alias("good"))),
        lambda pair: pair["long"].isNotNull())
    none = F.expr("cast(array() as array<struct<kind:int,i:int,gap:int,long:int,good:boolean>>)")
    return F.coalesce(F.transform(pairs, lambda pair, i: F.struct(
        F.lit(number).alias("kind"), i.alias("i"), pair["gap"].alias("gap"), pair["long"].alias("long"),
        pair["good"].alias("good"))), none)


def parts_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: row (its number), id, parts. The texts are scanned here and only here."""
    texts = docs.select(name_of(id_column).alias("id"), text_of(text_column).alias("text"))
    found = [_matches(F.col("text"), number, pattern, needs) for number, (_, pattern, needs) in enumerate(KINDS)]
    return stored(texts.select(F.monotonically_increasing_id().alias("row"), "id", F.concat(*found).alias("parts")), "secret-parts")


def _in(names: tuple[str, ...]) -> Column:
    return F.col("kind").isin([number for number, (name, _, _) in enumerate(KINDS) if name in names])


def spans_of(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """row, kind (number), start, end, weak: the strong spans and the weak ones with their complements.

    Positions are code points, ``end`` is exclusive.
    """
    each = parts.where(F.size("parts") > 0).select("row", F.inline("parts")).repartition("row")
    in_kind = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = (each.withColumn("end", F.sum(F.col("gap") + F.col("long")).over(in_kind))
              .withColumn("start", F.col("end") - F.col("long")).where("good"))
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)

    def near(names: tuple[str, ...]) -> Column:
        last_end = F.max(F.when(_in(names), F.col("end"))).over(before)
        next_start = F.min(F.when(_in(names), F.col("start"))).over(after)
        return (F.coalesce(last_end >= F.col("start") - scope, F.lit(False))
                | F.coalesce(next_start <= F.col("end") + scope, F.lit(False)))

    linked = placed.select("row", "kind", "start", "end", near(IDENTIFIERS).alias("identifier"), near(SECRETS).alias("secret"))
    complete = (F.when(_in(("user",)), F.col("secret")).when(_in(("key",)), F.col("identifier"))
                .when(_in(("endpoint",)), F.col("identifier") & F.col("secret")).otherwise(F.lit(True)))
    return linked.where(complete).select("row", "kind", "start", "end", (~_in(STRONG)).alias("weak"))


def _of_kind(number: int):
    return lambda span: span["kind"] == number


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(name) for name, _, _ in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scope: int = SCOPE
) -> DataFrame:
    """Per document: id, counts of the strong kinds, and the spans as kind:start:end texts."""
    parts = parts_of(docs, id_column, text_column)
    listed = spans_of(parts, scope).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "weak"))).alias("spans"))
    spans = F.coalesce(F.col("spans"), F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint,weak:boolean>>)"))
    strong = F.filter(F.col("all"), lambda s: ~s["weak"])
    rows = parts.select("row", "id").join(listed, "row", "left").select("id", spans.alias("all"))
    counts = [F.size(F.filter(F.col("all"), _of_kind(number))).cast("long").alias(f"n_{name}")
              for number, (name, _, _) in enumerate(KINDS[:len(STRONG)])]
    return rows.select(
        "id", *counts, _joined(strong).alias("base_spans"), _joined(F.col("all")).alias("spans"))
