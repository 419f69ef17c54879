"""Personal data: base patterns, and identifiers found by bootstrapped contexts (operator 10).

The base patterns give e-mail addresses, IP addresses, card and phone numbers. They are
the seeds: the words before them are lexical patterns (cues). Cues and the identifier-like
strings behind them form a graph; a cue is trusted by the share of its instances that are
known, an instance is known by the cues it stands behind, and a few rounds carry trust on.
Unseen instances behind trusted cues are added as spans of kind ``id``. DataFrame code only:
the text is read once, what it holds is stored, and the graph works on that.

Spans are code points, end exclusive. Strings that may be an ``id`` lie outside all base spans:
runs of letters, digits and ``_`` with at least 12 characters, two letters and two digits;
sequences of any length with a digit, joined by ``-``, ``.``, ``/``, and to groups of digits also
by brackets and blanks; addresses with ``at`` and ``dot``. They may overlap. A cue is the last
word within 40 characters before a string, with the signs between them.

Defined results: a null text is empty and has no spans; a null ``doc_id`` stays; repeated
rows are each returned; ties in ``start`` go by kind; an empty table gives no rows;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.array_scans import bound, cut, distinct_sorted, running, text_blocks
from claimloom.llm.shared import free_name, stored, whole_text

# Fixed values. Possessive and anchored forms of the base patterns: they match the same
# spans, without going back over long runs.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_IP_PARTS = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
_RUN = r"[A-Za-z0-9_]"
IDENTIFIER = rf"(?<!{_RUN})(?=[A-Za-z_]*+[0-9]){_RUN}{{12,}}+"
_WORD = rf"{_RUN}++(?:[./-]{_RUN}++)*+"
_DIGIT_AHEAD = r"(?=[A-Za-z_]*+(?:[./-][A-Za-z_]++)*+[./-]?+[0-9])"
SEQUENCE = (
    rf"(?<!{_RUN})(?<!{_RUN}[./-])[(\[]?+{_DIGIT_AHEAD}{_WORD}"
    rf"(?:[)\]]?+[\x20./-]?+[(\[]?+(?=[0-9]){_WORD})*+"
)
_AT = r"(?:\x20at\x20|\x20?[(\[{]\x20?(?:at|@)\x20?[)\]}]\x20?|\x20?@\x20?)"
_DOT = r"(?:\x20dot\x20|\x20?[(\[{]\x20?(?:dot|\.)\x20?[)\]}]\x20?|\.)"
WRITTEN = rf"(?i)(?<!{_LOCAL}){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++"
_CUE = r"([\p{L}]*[^\p{L}]*)$"
_CUE_CHARS = 40
_FEW_PAIRS = 4096  # more pairs of spans of one text are not compared one by one
_FAR = 1 << 62

KINDS = tuple(PATTERNS)
ADDED = "id"
_SPAN = "struct<start:long,rank:int,kind:string,end:long,cue:string,found:string>"


@dataclass(frozen=True)
class Trust:
    """When a cue counts: known share of its instances, distinct seeds, rounds of scoring."""

    share: float = 0.9
    seeds: int = 5
    rounds: int = 3


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right; every second digit from the right counts twice."""
    turned = F.reverse(digits)
    values = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substr(turned, i, F.lit(1)).cast("int") * (2 - i % 2),
    )
    sums = F.transform(values, lambda v: F.when(v > 9, v - 9).otherwise(v))
    return F.aggregate(sums, F.lit(0), lambda a, v: a + v) % 10 == 0


def _holds(kind: str, found: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    if kind == "ip":
        return found.rlike(_IP_PARTS)
    if kind == "card":
        digits = _digits(found)
        # the sequence of an impossible length is never built
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    if kind == ADDED:
        letters = F.length(F.regexp_replace(found, "[^A-Za-z]", ""))
        return (F.length(_digits(found)) >= 2) & (letters >= 2)
    return F.lit(True)


def _pair_length(pair: Column) -> Column:
    found = F.coalesce(pair["found"], F.lit(""))
    return (F.length(pair["gap"]) + F.length(found)).cast("long")


def _spans(
    kind: str, pattern: str, text: Column, needs: str, holds: Callable[..., Column] = _holds
) -> Column:
    """All matches that hold, with place and cue. ``needs`` is what a match must contain, a
    digit if it is empty."""
    rank = (*KINDS, ADDED).index(kind)
    none = F.array().cast(f"array<{_SPAN}>")
    # the parts between the matches give the places: one more part than matches
    pairs = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
    )

    def span(pair: Column, end: Column) -> Column:
        gap, found = pair["gap"], pair["found"]
        cue = F.lower(F.regexp_extract(F.right(gap, F.lit(_CUE_CHARS)), _CUE, 1))
        made = F.struct(
            (end - F.length(found)).alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"),
            end.alias("end"),
            F.regexp_replace(cue, r"\s+", " ").alias("cue"),
            found.alias("found"),
        ).cast(_SPAN)
        return F.when(found.isNotNull() & holds(kind, found), made)

    def located(parts: Column) -> Column:
        lengths = F.transform(parts, _pair_length)
        spans = bound(
            running(lengths, 0, add),
            lambda ends: F.transform(parts, lambda p, i: span(p, F.get(ends, i))),
        )
        return F.array_compact(spans)

    spans = bound(pairs, located)
    contains = F.lower(text).contains(needs) if needs else text.rlike("[0-9]")
    return F.when(contains, spans).otherwise(none)


def _has_digit(kind: str, found: Column) -> Column:
    return found.rlike("[0-9]")


def _any(kind: str, found: Column) -> Column:
    return F.lit(True)


def candidate_spans(text: Column) -> Column:
    """Spans of all strings that may be an identifier, where cues decide."""
    runs = _spans(ADDED, IDENTIFIER, text, "")
    sequences = _spans(ADDED, SEQUENCE, text, "", _has_digit)
    written = F.concat(
        _spans(ADDED, WRITTEN, text, "at", _any),
        # those with "@" only, where base patterns do not match
        F.when(
            ~F.lower(text).contains("at"), _spans(ADDED, WRITTEN, text, "@", _any)
        ).otherwise(F.array().cast(f"array<{_SPAN}>")),
    )
    return distinct_sorted(F.concat(runs, sequences, written))


_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}


def base_spans(text: Column) -> Column:
    """Spans of the four base kinds, by start and then kind."""
    found = [_spans(kind, p, text, _NEEDS[kind]) for kind, p in PATTERNS.items()]
    return F.array_sort(F.concat(*found))


def _described(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _graph(read: DataFrame) -> DataFrame:
    """Edges between cues and distinct instances: ``cue, found, seed``."""

    def edges(column: str, seed: bool) -> DataFrame:
        return (
            read.where(F.size(column) > 0)
            .select(F.explode(column).alias("span"))
            .select("span.cue", "span.found", F.lit(seed).alias("seed"))
            .where(F.length("cue") > 0)
        )

    return (
        edges("base", True)
        .unionByName(edges("candidates", False))
        .groupBy("cue", "found")
        .agg(F.max("seed").alias("seed"))
    )


def trusted_cues(read: DataFrame, trust: Trust) -> DataFrame:
    """Cues whose instances are known well enough, after some rounds over the graph."""
    graph = stored(_graph(read), "cue-graph")
    # seeds stay known, so only their number by cue goes round
    seeds = graph.where("seed").groupBy("cue").agg(F.count("*").alias("seeds"))
    unseen = graph.where("not seed").select("cue", "found")
    known = unseen.select("found", F.lit(0.0).alias("known")).distinct()
    cues = None
    for _ in range(trust.rounds):
        heard = (
            unseen.join(known, "found")
            .groupBy("cue")
            .agg(
                F.sum("known").alias("known"),
                F.count("*").alias("others"),
                F.count_if(F.col("known") >= trust.share).alias("sure"),
            )
        )
        base, sure = F.coalesce("seeds", F.lit(0)), F.coalesce("sure", F.lit(0))
        share = (base + F.coalesce("known", F.lit(0.0))) / (base + F.coalesce("others", F.lit(0)))
        # rounded, so that the order of the sums does not matter
        cues = stored(
            # instances found for sure in the rounds before count as seeds too
            seeds.join(heard, "cue", "full")
            .select("cue", (base + sure).alias("seeds"), F.round(share, 6).alias("share"))
            .where(F.col("seeds") >= trust.seeds),
            "cues",
        )
        # an instance is unknown only if all its cues are wrong about it
        doubt = F.sum(F.log(1.0000001 - F.coalesce("share", F.lit(0.0))))
        known = stored(
            unseen.join(cues, "cue", "left")
            .groupBy("found")
            .agg((1 - F.exp(doubt)).alias("known")),
            "instances",
        )
    return cues.where(F.col("share") >= trust.share).select("cue")


def read_texts(docs: DataFrame) -> DataFrame:
    """What the graph and the result need of each row, read from its whole text once."""
    text = whole_text()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    read = rows.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        base_spans(F.col("text")).alias("base"),
        candidate_spans(F.col("text")).alias("runs"),
    )
    few = F.size("base") * F.size("runs") <= _FEW_PAIRS
    outside = F.when(few, _outside_by_pairs(F.col("base"), F.col("runs"))).otherwise(
        _outside_in_order(F.col("base"), F.col("runs"))
    )
    return read.select("doc_id", "text_hash", "base", outside.alias("candidates"))


def _outside_by_pairs(base: Column, runs: Column) -> Column:
    """The runs that overlap no base span, for few of both."""
    return F.filter(
        runs,
        lambda c: ~F.exists(base, lambda b: (c["start"] < b["end"]) & (b["start"] < c["end"])),
    )


def _outside_in_order(base: Column, runs: Column) -> Column:
    """The same by going over all spans by their start, once forwards and once backwards."""

    def mark(is_run: int) -> Callable[[Column], Column]:
        return lambda s: F.struct(
            s["start"].alias("at"), F.lit(is_run).alias("is_run"), s.alias("span")
        )

    marks = F.array_sort(F.concat(F.transform(base, mark(0)), F.transform(runs, mark(1))))

    def kept(m: Column) -> Column:
        none = F.lit(_FAR).cast("long")
        ends = F.transform(m, lambda x: F.when(x["is_run"] == 0, x["span"]["end"]).otherwise(-none))
        starts = F.transform(m, lambda x: F.when(x["is_run"] == 0, x["at"]).otherwise(none))
        before = running(ends, -_FAR, F.greatest)
        after = running(F.reverse(starts), _FAR, F.least)

        def free(ended: Column, to_come: Column) -> Column:
            def test(x: Column, i: Column) -> Column:
                next_start = F.get(to_come, F.size(to_come) - 1 - i)
                apart = (F.get(ended, i) <= x["at"]) & (next_start >= x["span"]["end"])
                return F.when((x["is_run"] == 1) & apart, x["span"])

            return F.array_compact(F.transform(m, test))

        return bound(before, lambda ended: bound(after, lambda to_come: free(ended, to_come)))

    return bound(marks, kept)


def find_private(docs: DataFrame, trust: Trust = Trust()) -> DataFrame:
    """``doc_id, text_hash, base, spans`` of each row; spans are the base ones and the added."""
    read = stored(read_texts(docs), "private-data")
    cues = trusted_cues(read, trust)
    row_key = ["doc_id", "text_hash"]
    # rows with equal id and text have equal spans, hence one row per key
    added = (
        read.where(F.size("candidates") > 0)
        .select(*row_key, F.explode("candidates").alias("span"))
        .join(cues.toDF("good"), F.col("span.cue") == F.col("good"), "left_semi")
        .groupBy(*row_key)
        .agg(F.collect_set("span").alias("added"))
        .withColumnsRenamed({"doc_id": "added_id", "text_hash": "added_hash"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("added_id")) & (
        F.col("text_hash") == F.col("added_hash")
    )
    none = F.array().cast(f"array<{_SPAN}>")
    spans = F.array_sort(F.concat("base", F.coalesce("added", none)))
    return read.join(added, same, "left").select(*row_key, "base", spans.alias("spans"))


def describe(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their description, and all spans as text."""

    def count(kind: str) -> Column:
        n = F.size(F.filter("base", lambda s: s["kind"] == kind))
        return n.cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(_described(F.col("base")), 256).alias("base_sha256"),
        _described(F.col("spans")).alias("spans"),
    )


def _masked(text: Column, spans: Column) -> Column:
    """Each span replaced by its kind in brackets; spans that overlap become one."""
    reach = running(F.transform(spans, lambda s: s["end"]), 0, F.greatest)

    def masked(blocks: Column, ends: Column) -> Column:
        def piece(span: Column, i: Column) -> Column:
            at = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(ends, i - 1))
            mark = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
            between = cut(blocks, at, span["start"] - at)
            return F.when(span["start"] >= at, F.concat(between, mark))

        at = F.element_at(ends, -1)
        rest = cut(blocks, at, F.length(text) - at)
        return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

    return bound(text_blocks(text), lambda b: bound(reach, lambda ends: masked(b, ends)))


def mask_private(docs: DataFrame, trust: Trust = Trust()) -> DataFrame:
    """``docs`` with the spans in ``text`` masked; other columns, and clean rows, as they were.

    A column ``n_chars`` is set to the new length where a text was changed.
    """
    found = find_private(docs, trust).where(F.size("spans") > 0)
    id_name, hash_name, spans_name = (
        free_name(docs.columns, n) for n in ("span_doc_id", "span_text_hash", "private_spans")
    )
    found = found.select(
        F.col("doc_id").alias(id_name),
        F.col("text_hash").alias(hash_name),
        F.col("spans").alias(spans_name),
    ).dropDuplicates([id_name, hash_name])
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_name)) & (
        F.xxhash64(whole_text()) == F.col(hash_name)
    )
    dirty = F.col(spans_name).isNotNull()
    text = F.when(dirty, _masked(whole_text(), F.col(spans_name))).otherwise(F.col("text"))
    changed = {"text": text}
    joined = docs.join(found, same, "left")
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        joined = joined.withColumn("text", text)
        changed = {"n_chars": F.when(dirty, length).otherwise(F.col("n_chars"))}
    return joined.withColumns(changed).select(*docs.columns)
