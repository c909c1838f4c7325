"""Secret scan that links the parts of a credential.

Strong parts are reported wherever they stand: ``assign`` (a secret-like name with a value of eight
characters or more), ``access`` (an access identifier) and ``hex`` (32 or more hexadecimal digits).
Weak parts mean nothing alone: a named ``user`` identifier, a ``pass`` value (four characters under
a weaker name, any value under a secret-like name that ``assign`` leaves), a long mixed ``token`` and
an ``endpoint`` (address with a host). Names may follow a prefix that ends in ``_`` or ``-``. They are reported only where
complementary parts stand within ``reach`` code points of each other in one text, the scope:

* an identifier with a secret (weak or strong) in scope,
* a weak secret with an identifier or an endpoint in scope; where its value may be an ordinary word (up to 16
  letters, no digit, symbol or mixed case), only with an identifier, as prose has words beside addresses,
* an endpoint with both an identifier and a secret in scope.

Parts become intervals of code points. Each interval, widened by the reach, is put into bins of
that length, and one window per (text, bin) carries the furthest end before and the nearest start
after of each role along the sorted parts: an interval join that emits no pairs and whose groups
are as small as a bin, however long a text is. Only intervals are shuffled, never texts.

Defined cases: null text counts as empty; a text without parts gives empty spans; rows equal in
doc_id and text get equal results, one row each; weak spans that overlap a strong span are part of
it and not reported again; positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.common import written
from logwarden.llm.tables import free_name, let, whole_text

REACH = 200
# Fixed values of the base rules.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
STRONG = ("assign", "access", "hex")
# Weak parts by kind: role and pattern.
WEAK = {
    "user": ("id", "(?<![A-Za-z0-9])(?i:user(?:name)?|login|account(?:_id)?|client_?id|access_?key_?id)[\"']?\\x20*[:=]\\x20*[\"']?"
                   "[A-Za-z0-9@._-]{3,}"),
    "pass": ("secret", "(?<![A-Za-z0-9])(?:(?i:pwd|pass|passphrase|credential|auth)[\"']?\\x20*[:=]\\x20*[\"']?[^\\x20\"'\\x09-\\x0D]{4,}"
                       "|(?i:password|passwd|secret|token|api[_-]?key)[\"']?\\x20*[:=]\\x20*[\"']?[^\\x20\"'\\x09-\\x0D]+)"),
    # A stretch with slashes can be the path of an address: over 40 characters it must not follow a host.
    "token": ("secret", "(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[A-Z0-9+/_=-]*[a-z])(?=[a-z0-9+/_=-]*[A-Z])"
                        "(?:[A-Za-z0-9+_-]{24,}|[A-Za-z0-9+/_-]{40}|(?<![.])(?!//)[A-Za-z0-9+/_-]{41,})={0,2}(?![A-Za-z0-9+/_=-])"),
    "endpoint": ("place", "(?<![A-Za-z0-9])(?:[a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9][^\\x20\"'<>\\x09-\\x0D]*"
                          "|(?i:host|endpoint|server)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9][A-Za-z0-9.:-]+)"),
}
# A named value that may well be an ordinary word: letters of one case, or capitalised, up to sentence marks.
PLAIN_VALUE = "[:=]\\x20*[\"']?[(\\[]?(?:\\p{Lu}?[\\p{Ll}\\p{Lo}\\p{M}'\u2019-]{0,15}|\\p{Lu}{1,16})[.,;:!?)\\]]*$"
CHUNK = 1024

PART = "struct<start:bigint,rank:int,end:bigint,kind:string,role:string>"


def _running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array. Each step doubles how far a total reaches, so n values take n log n work."""
    steps = F.array(*[F.lit(1 << k) for k in range(31)])
    return let(values, lambda v: F.aggregate(
        F.filter(steps, lambda w: w < F.size(v)), v,
        lambda s, w: F.transform(s, lambda x, i: F.when(i >= w, add(F.get(s, i - w), x)).otherwise(x))))


def _spans(text: Column, pattern: str, rank: int, kind: str, role: Callable[[Column], Column],
           keep: Callable[[Column], Column] | None = None) -> Column:
    """All matches of a pattern as structs of start, rank, end, kind, role; ``role`` and ``keep`` judge a matched string.

    The text between matches comes from splitting at the pattern, so ends are running lengths.
    """
    empty = F.array().cast(f"array<{PART}>")

    def placed(found: Column) -> Column:
        def lay(gaps: Column) -> Column:
            sizes = F.transform(found, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("bigint"))

            def parts_at(ends: Column) -> Column:
                def part(m: Column, i: Column) -> Column:
                    end = F.get(ends, i)
                    made = F.struct((end - F.length(m)).alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
                                    F.lit(kind).alias("kind"), role(m).alias("role"))
                    return F.when(keep(m), made) if keep else made

                made = F.transform(found, part)
                return (F.array_compact(made) if keep else made).cast(f"array<{PART}>")

            return let(_running(sizes, lambda a, b: a + b), parts_at)

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), lay)).otherwise(empty)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def parts(text: Column) -> Column:
    """All strong and weak parts of a text; the rank is the place of the kind in the lists above."""
    def always(role: str) -> Callable[[Column], Column]:
        return lambda m: F.lit(role)

    def word_or(role: str) -> Callable[[Column], Column]:
        return lambda m: F.when(m.rlike(PLAIN_VALUE), F.lit("word")).otherwise(F.lit(role))

    # Maximal runs of 32 digits, or 16 characters, are what the open patterns match and keep.
    strong = [
        _spans(text, ASSIGN, 0, "assign", always("secret"), lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8),
        _spans(text, ACCESS.replace("]+", "]{12,}"), 1, "access", always("id")),
        _spans(text, HEX.replace("]+", "]{32,}"), 2, "hex", always("secret"))]
    weak = [_spans(text, pattern, len(STRONG) + k, kind, word_or(role) if kind == "pass" else always(role)) for k, (kind, (role, pattern)) in enumerate(WEAK.items())]
    return F.concat(*strong, *weak)


def _linked(rows: DataFrame, reach: int) -> DataFrame:
    """Exploded parts ``p`` with ``linked``: strong, or weak, clear of strong ones and with its complement within reach."""
    width = F.lit(reach).cast("bigint")
    bins = F.sequence(F.call_function("div", F.greatest(F.col("p.start") - reach, F.lit(0)), width),
                      F.call_function("div", F.col("p.end") + reach, width))
    spread = rows.withColumn("bin", F.explode(bins))
    order = Window.partitionBy("doc_id", "digest", "bin").orderBy("p.start", "p.rank", "p.end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)

    def near(which: Column, distance: int) -> Column:
        """Whether a part of some sort lies closer than ``distance`` to this one."""
        left = F.max(F.when(which, F.col("p.end"))).over(before)
        right = F.first(F.when(which, F.col("p.start")), ignorenulls=True).over(after)
        return F.coalesce(F.col("p.start") - left < distance, F.lit(False)) | F.coalesce(right - F.col("p.end") < distance, F.lit(False))

    seen = spread.select("doc_id", "digest", "p", near(F.col("p.role") == "id", reach + 1).alias("by_id"),
                         near(F.col("p.role").isin("secret", "word"), reach + 1).alias("by_secret"),
                         near(F.col("p.role") == "place", reach + 1).alias("by_place"),
                         near(F.col("p.rank") < len(STRONG), 0).alias("inside"))
    # Intervals within reach of each other share a bin; what one bin shows holds for the part.
    whole = seen.groupBy("doc_id", "digest", "p").agg(*[F.bool_or(c).alias(c) for c in ("by_id", "by_secret", "by_place", "inside")])
    role = F.col("p.role")
    complete = (F.when(role == "id", F.col("by_secret")).when(role == "word", F.col("by_id")).when(role == "secret", F.col("by_id") | F.col("by_place"))
                .otherwise(F.col("by_id") & F.col("by_secret")))
    return whole.select("doc_id", "digest", "p", ((F.col("p.rank") < len(STRONG)) | (complete & ~F.col("inside"))).alias("linked"))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Per row: ``doc_id``, ``digest`` of the text and ``spans``, structs of start, rank, end, kind, role in that order."""
    text = whole_text(docs)
    found = docs.select(docs["doc_id"].alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("digest"), parts(text).alias("parts"))
    # Rows equal in id and text are one from here on; each task sends one of them.
    alike = written(found.groupBy("doc_id", "digest").agg(F.first("parts").alias("parts"), F.count(F.lit(1)).alias("rows")), "parts")
    weak = F.exists("parts", lambda p: p["rank"] >= len(STRONG))
    plain = alike.where(~weak).select("doc_id", "digest", "rows", F.sort_array("parts").alias("spans"))
    loose = alike.where(weak)
    linked = _linked(loose.select("doc_id", "digest", F.explode("parts").alias("p")), reach)
    kept = linked.groupBy("doc_id", "digest").agg(
        F.sort_array(F.collect_list(F.when(F.col("linked"), F.col("p")))).alias("spans"))
    sizes = loose.select("doc_id", "digest", "rows")
    same = sizes["doc_id"].eqNullSafe(kept["doc_id"]) & (sizes["digest"] == kept["digest"])
    joined = sizes.join(kept, same).select(sizes["doc_id"], sizes["digest"], "rows", "spans")
    both = plain.unionByName(joined)
    return both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows")))).drop("copy", "rows")


def redact(docs: DataFrame, mark: str = "[REDACTED]", reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span replaced, overlapping spans by one mark; ``n_chars`` follows the text."""
    own_id, own_digest, own_spans, digest = (free_name(docs, n) for n in ("_id", "_digest", "_spans", "_own_digest"))
    found = scan(docs, reach).where("size(spans) > 0").distinct().select(
        F.col("doc_id").alias(own_id), F.col("digest").alias(own_digest), F.col("spans").alias(own_spans))
    text = whole_text(docs)
    own = docs.withColumn(digest, F.sha2(text.cast("binary"), 256))
    met = own.join(found.hint("shuffle_hash"), own["doc_id"].eqNullSafe(found[own_id]) & (own[digest] == found[own_digest]), "left")
    spans = found[own_spans]

    def cleaned(chunks: Column) -> Column:
        size = F.lit(CHUNK).cast("bigint")

        def stretch(start: Column, end: Column) -> Column:
            """Code points start to end; only the chunks they lie in are read."""
            first, last = F.call_function("div", start, size), F.call_function("div", end, size)
            near = F.array_join(F.slice(chunks, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
            return F.substring(near, (start - first * size + 1).cast("int"), (end - start).cast("int"))

        def marked(ends: Column) -> Column:
            # A run of spans that overlap or touch becomes one mark; the text before each run stays.
            fresh = F.array_compact(F.transform(spans, lambda x, i: F.when((i == 0) | (x["start"] > F.get(ends, i - 1)), F.struct(
                F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1)).cast("bigint").alias("from"), x["start"].alias("to")))))
            kept = F.transform(fresh, lambda g: F.concat(stretch(g["from"], g["to"]), F.lit(mark)))
            tail = stretch(F.get(ends, F.size(ends) - 1), F.length(text).cast("bigint"))
            return F.concat(F.array_join(kept, ""), tail)

        return let(_running(F.transform(spans, lambda x: x["end"]), F.greatest), marked)

    clean = F.when(spans.isNull(), docs["text"]).otherwise(let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), cleaned))
    size = F.when(spans.isNull(), docs["n_chars"]).otherwise(F.length(clean)) if "n_chars" in docs.columns else None
    return met.select([clean.alias(c) if c == "text" else size.cast(dict(docs.dtypes)[c]).alias(c) if c == "n_chars" else docs[c]
                       for c in docs.columns])
