"""Personal data in texts, in column expressions only: fixed forms, and identifiers
found by the words around them.

E-mail and IP addresses, card and phone numbers are found by pattern and checked.
They are the seeds. The word before a seed and the word after it are lexical
patterns. Spark scores them against all documents: the share of a word's
occurrences that stand beside an identifier. Tokens with a digit or an @ beside
such a word are instances, and score by their patterns; patterns score again by
their instances. A word takes part once it was seen beside several seeds, or beside
instances that a word with a high score found, each as far as it is believed. So
labels that never stand beside a seed are reached, too. Rounds go on as long as they
bring further words. Patterns that end with high scores find the identifiers that no
fixed form covers, as ``context``.

Positions are code points, ends exclusive. Cases: a null text is empty and has no
spans; texts are read whole, of any length; rows with one text share its spans,
each row of its own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockglass.llm.common import GAP, let, materialize

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3  # at least
LEAST_SEEDS = 3  # seeds beside a pattern that takes part, different ones; found instances count their belief
LEAST_SCORE = 0.7  # of a pattern that is used
_BLANKS = "\t\n\x0b\x0c\r"

# Possessive quantifiers keep the matcher from going back, which never helps here,
# and a match begins at the first character it can, so no run is read twice.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SIGNS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+"}  # without one no match
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"


def _running(lengths: Column) -> Column:
    """Running sums: each round adds the value twice as far back as the round before."""

    def add(sums: Column, back: Column) -> Column:
        return F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - back), F.lit(0)))

    rounds = F.ceil(F.log2(F.size(lengths) + F.lit(0.5))).cast("int")
    backs = F.transform(F.sequence(F.lit(0), rounds), lambda k: F.pow(F.lit(2), k).cast("int"))
    return let(lengths, lambda x: F.when(F.size(x) > 0, F.aggregate(backs, x, add)).otherwise(x))


def located(text: Column, pattern: str) -> Column:
    """All matches, as an array of start, end, hit, gap, next_gap: the text of the
    match and what stands between it and its neighbours."""

    def place(parts: Column) -> Column:
        gaps, hits = parts["gaps"], parts["hits"]
        lengths = F.transform(hits, lambda h, i: F.length(h) + F.length(F.get(gaps, i)))

        def one(hit: Column, ends: Column, i: Column) -> Column:
            end = F.get(ends, i)
            return F.struct(
                (end - F.length(hit)).alias("start"),
                end.alias("end"),
                hit.alias("hit"),
                F.get(gaps, i).alias("gap"),
                F.get(gaps, i + 1).alias("next_gap"),
            )

        return let(_running(lengths), lambda ends: F.transform(hits, lambda h, i: one(h, ends, i)))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(F.struct(F.split(text, pattern, -1).alias("gaps"), hits.alias("hits")), place)


def _valid(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


_SPAN = "array<struct<start:int,end:int,hit:string,left:string,right:string>>"


def _word_before(gap: Column) -> Column:
    blanks = F.rtrim(F.translate(gap, _BLANKS, " " * len(_BLANKS)))
    return F.lower(F.substring_index(blanks, " ", -1))


def _word_after(gap: Column) -> Column:
    blanks = F.ltrim(F.translate(gap, _BLANKS, " " * len(_BLANKS)))
    return F.lower(F.substring_index(blanks, " ", 1))


def _spans(text: Column, kind: str) -> Column:
    """start, end, hit and the words around it, of a kind's matches that hold."""
    found = F.filter(located(text, PATTERNS[kind]), lambda m: _valid(kind, m["hit"]))
    slim = F.transform(found, _with_words)
    return F.when(text.rlike(_SIGNS[kind]), slim).otherwise(F.array().cast(_SPAN))


def _with_words(m: Column) -> Column:
    return F.struct(
        m["start"].alias("start"),
        m["end"].alias("end"),
        F.lower(m["hit"]).alias("hit"),
        _word_before(m["gap"]).alias("left"),
        _word_after(m["next_gap"]).alias("right"),
    )


def _covered(token: Column, spans: Column) -> Column:
    """Whether one of the spans, which are in order and apart, overlaps the token.

    The last that starts before the token's end is found by halving."""

    def halve(at: Column, step: Column) -> Column:
        further = at + step
        return F.when(F.get(spans, further - 1)["start"] < token["end"], further).otherwise(at)

    steps = F.array(*[F.lit(1 << k) for k in reversed(range(31))])
    needed = F.filter(steps, lambda s: s <= F.size(spans))
    last = F.aggregate(needed, F.lit(0), halve)
    return F.coalesce(F.get(spans, last - 1)["end"] > token["start"], F.lit(False))


def found_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, an array of spans for each kind, and ``other``: tokens with a
    digit or an @ that none of them covers."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    rows = rows.select("doc_id", "text_hash", "text", *[_spans(F.col("text"), k).alias(k) for k in KINDS])
    tokens = F.transform(located(F.col("text"), _TOKEN), _with_words)

    def free(token: Column) -> Column:
        return ~reduce(Column.__or__, [_covered(token, F.col(k)) for k in KINDS])

    other = F.when(F.col("text").rlike("[0-9@]"), F.filter(tokens, free)).otherwise(F.array().cast(_SPAN))
    return rows.select("doc_id", "text_hash", *KINDS, other.alias("other"))


def _edges(rows: DataFrame, spans: Column, known: bool) -> DataFrame:
    """pattern, instance, known: the words on both sides of each span."""
    one = rows.select(F.explode(spans).alias("s"))
    sides = F.array(
        F.struct(F.lit("before").alias("side"), F.col("s.left").alias("word")),
        F.struct(F.lit("after").alias("side"), F.col("s.right").alias("word")),
    )
    edges = one.select(
        F.col("s.hit").alias("instance"), F.explode(sides).alias("p"), F.lit(known).alias("known")
    )
    words = edges.filter((F.col("p.word") != "") & ~F.col("p.word").rlike("[0-9@]"))
    return words.select("p.side", "p.word", "instance", "known")


def _candidate_edges(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """side, word, instance, n, known, where known holds for the instance wherever it
    stands; and side, word, total, the number of times each of the patterns is seen."""
    seeds = _edges(found, F.concat(*KINDS), True)
    edges = seeds.unionAll(_edges(found, F.col("other"), False)).groupBy("side", "word", "instance")
    edges = edges.agg(F.count("*").alias("n"), F.max("known").alias("known"))
    edges = materialize(edges, "personal-all-edges")
    # Support is at most the number of instances, so fewer can never be enough.
    patterns = edges.groupBy("side", "word").agg(F.count("*").alias("instances"), F.sum("n").alias("n"))
    patterns = materialize(patterns.filter(F.col("instances") >= LEAST_SEEDS), "personal-patterns")
    seeds = edges.filter("known").select("instance").distinct().withColumn("seed", F.lit(True))
    edges = edges.join(patterns.select("side", "word"), ["side", "word"], "left_semi").drop("known")
    edges = edges.join(seeds, "instance", "left").withColumn("known", F.coalesce("seed", F.lit(False)))
    edges = materialize(edges.drop("seed"), "personal-edges")
    words = docs.select(F.explode(F.split(F.lower("text"), GAP)).alias("word")).filter("word <> ''")
    totals = words.groupBy("word").agg(F.count("*").alias("total"))
    # A word at the edge of a token, as in "(tel:", may count fewer times than it is seen.
    total = F.greatest(F.coalesce("total", F.lit(0)), "n").alias("total")
    patterns = patterns.join(totals, "word", "left").select("side", "word", total)
    return edges, materialize(patterns, "personal-totals")


def context_patterns(docs: DataFrame, found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """side, word, score of the patterns that are used."""
    edges, patterns = _candidate_edges(docs, found)
    seeds = edges.filter("known").select("instance").distinct()
    seeds = materialize(seeds.select("instance", F.lit(1.0).alias("belief"), F.lit(1.0).alias("trust")), "personal-seeds")
    beliefs, seen, k = seeds, None, 0
    while True:
        beside = edges.join(beliefs, "instance").groupBy("side", "word")
        beside = beside.agg(F.sum(F.col("n") * F.col("belief")).alias("found"), F.sum("trust").alias("support"))
        admitted = beside.filter(F.col("support") >= LEAST_SEEDS).join(patterns, ["side", "word"])
        share = F.col("found") / (F.col("total") + 1)
        scored = materialize(admitted.select("side", "word", share.alias("score")), "personal-scores")
        trusted = F.col("score") >= LEAST_SCORE
        k += 1
        # Scores only grow from round to round, and so do the patterns, up to all words.
        state = scored.agg(F.count("*"), F.count_if(trusted)).first()
        if k >= rounds and state == seen:
            return scored.filter(trusted)
        seen = state
        doubt = F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.99)))))
        others = edges.filter("not known").join(scored, ["side", "word"]).groupBy("instance")
        others = others.agg((1 - doubt).alias("belief"), F.max(trusted).alias("trusted"))
        trust = F.when(F.col("trusted"), F.col("belief")).otherwise(0.0).alias("trust")
        beliefs = seeds.unionAll(others.select("instance", "belief", trust))


def _discovered(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """doc_id, text_hash, context: the spans beside a pattern, an array for each text."""
    spans = found.filter(F.size("other") > 0).select("doc_id", "text_hash", F.explode("other").alias("s"))

    def beside(side: str, word: str) -> DataFrame:
        used = patterns.filter(F.col("side") == side).select("word")
        return spans.join(used, F.col(word) == F.col("word"), "left_semi")

    hits = beside("before", "s.left").unionAll(beside("after", "s.right"))
    one = F.struct(F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    return hits.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(one)).alias("context"))


_CONTEXT = "array<struct<start:int,end:int>>"


def _found_and_context(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``found_spans``, and the identifiers found by their context: c_id, c_hash, context,
    a row for each text that has any."""
    found = materialize(found_spans(docs), "personal-found")
    context = materialize(_discovered(found, context_patterns(docs, found)), "personal-context")
    c_id, c_hash = F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash")
    return found, context.select(c_id, c_hash, "context")


def _with_context(rows: DataFrame, context: DataFrame) -> DataFrame:
    """rows, which have doc_id and text_hash, and ``context``. Few texts have any; without
    one there is nothing to join."""
    if context.isEmpty():
        return rows.withColumn("context", F.array().cast(_CONTEXT))
    same = F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash"))
    joined = rows.join(context, same, "left").drop("c_id", "c_hash")
    return joined.withColumn("context", F.coalesce("context", F.array().cast(_CONTEXT)))


def _joined(kinds: tuple[str, ...]) -> Column:
    def texts(kind: str) -> Column:
        return F.transform(kind, lambda s: F.concat(F.lit(kind + ":"), s["start"], F.lit(":"), s["end"]))

    return F.array_join(F.concat(*map(texts, kinds)), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each kind, base_sha256, spans."""
    found, context = _found_and_context(docs)
    rows = _with_context(found.drop("other"), context)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in (*KINDS, "context")]
    digest = F.sha2(_joined(KINDS).cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", *counts, digest, _joined((*KINDS, "context")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """docs with each span in ``text`` replaced by its kind in brackets; overlapping
    spans become one. Other columns are unchanged; so are texts without spans."""

    def tagged(kind: str, spans: Column) -> Column:
        def one(s: Column) -> Column:
            return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"))

        return F.transform(spans, one)

    # Fixed forms are found once more where the text is, so that no text has to move.
    _, context = _found_and_context(docs)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text_hash = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    rows = _with_context(docs.select(whole, "doc_id", "text", text_hash), context)
    kinds = [tagged(k, _spans(F.coalesce("text", F.lit("")), k)) for k in KINDS]
    spans = F.array_sort(F.concat(*kinds, tagged("context", F.col("context"))))
    rows = rows.select("row", "text", spans.alias("spans"))

    def cut(state: Column, span: Column) -> Column:
        begins = span["start"] >= state["at"]
        gap = F.substring("text", state["at"] + 1, span["start"] - state["at"])
        mark = F.concat(gap, F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(begins, F.concat(state["out"], F.array(mark))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = F.array(F.substring("text", F.col("cut.at") + 1, F.length("text")))
    rows = rows.withColumn("cut", F.when(F.size("spans") > 0, F.aggregate("spans", start, cut)))
    text = F.coalesce(F.array_join(F.concat("cut.out", rest), ""), F.col("text"))
    return rows.select(F.col("row").withField("text", text).alias("row")).select("row.*")
