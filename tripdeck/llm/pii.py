"""Personal data: base patterns, and terms that give a protected entity away.

All of it is DataFrame expressions. Spans of a kind are found by marking each match of its
pattern and cutting the marked text there, which leaves positions as running lengths of the
pieces. The information-theoretic step then takes each distinct entity (a matched string) as
something to protect, however rare it is. A term in the sentence of an entity discloses it if their
pointwise mutual information over the corpus reaches the share ``threshold`` of the entity's
information content; log2(N n(t,e) / (n(t) n(e))) >= threshold * log2(N / n(e)), with numbers of
documents; and if chance would bring them together as often with a probability of at most
``significance``, by Hoeffding's bound on the hypergeometric tail. For a word and an entity that
both stand in one document only that probability is 1 / N. Such terms get spans of the kind ``term`` wherever they occur, and are
removed with the base spans when a text is sanitised.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdeck.llm.stages import small, written

MARK, OTHER = "\u0001", "\u0002"
BROADCAST_BYTES = 64 << 20  # disclosing terms per document that every executor gets at most

# Kinds in the order in which spans of one start are listed. The patterns are those
# of the contract, with possessive quantifiers, and starts inside a run that can't match are
# skipped; both leave the matches as they are and the time linear.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Ends of sentences; what a phone number could go on with doesn't follow.
BOUNDARY = r"[.!?](?:\s++(?![().0-9-]))|[\u3002\uff01\uff1f]|\n\s*+\n"
TERM = "term"
SPAN = "struct<start:int,rank:int,end:int,kind:string>"
EMPTY = f"cast(array() as array<{SPAN}>)"


def _luhn(digits: Column) -> Column:
    """Whether the last digit is the check digit of a string of digits."""
    figures = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    total = F.aggregate(
        F.transform(figures, lambda c, i: F.when(i % 2 == 0, c.cast("int"))
                    .when(c.cast("int") >= 5, c.cast("int") * 2 - 9)
                    .otherwise(c.cast("int") * 2)),
        F.lit(0), lambda a, v: a + v)
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        digits = F.regexp_replace(match, "[ -]", "")
        return F.length(digits).between(14, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def _marked_spans(text: Column, pattern, kind: str, rank: int, valid) -> Column:
    """Spans of the valid matches of ``pattern`` (a Column or a string) in ``text``."""
    clean = F.translate(text, MARK, OTHER)  # neither is in any pattern; positions stay
    pieces = F.split(F.regexp_replace(clean, pattern, F.lit(f"{MARK}$0{MARK}")), MARK, -1)
    state = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"),
                     F.expr(EMPTY).alias("spans"))

    def step(acc, piece):
        end = acc["at"] + F.length(piece)
        span = F.struct(acc["at"].alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
                        F.lit(kind).alias("kind"))
        return F.struct(end.alias("at"), (~acc["inside"]).alias("inside"),
                        F.when(acc["inside"] & valid(piece),
                               F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(pieces, state, step, lambda acc: acc["spans"])


def base_spans(text: Column) -> Column:
    """All base spans of a text, ascending by start, then kind; an empty array for null."""
    worth = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"),
             "card": text.rlike(r"[0-9][\x20-]?[0-9]"), "phone": text.rlike(r"\+[0-9]")}
    found = [F.when(worth[k], _marked_spans(text, F.lit(PATTERNS[k]), k, n,
                                            lambda m, k=k: _valid(k, m)))
             .otherwise(F.expr(EMPTY)) for n, k in enumerate(KINDS)]
    return F.sort_array(F.concat(*found))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) >= 3)


def _contexts(text: Column, spans: Column, reach: int) -> Column:
    """(own, around) of each sentence with a span: its text, and with ``reach`` characters more
    on either side, less a word cut there. No base pattern matches across an end of a sentence."""
    clean = F.translate(text, MARK, OTHER)
    pieces = F.split(F.regexp_replace(clean, BOUNDARY, f"$0{MARK}"), MARK, -1)
    state = F.struct(F.lit(0).alias("at"),
                     F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("all"))

    def step(acc, piece):
        end = acc["at"] + F.length(piece)
        return F.struct(end.alias("at"), F.concat(acc["all"], F.array(F.struct(
            acc["at"].alias("start"), end.alias("end")))).alias("all"))
    # bound to a lambda's variable: the optimiser would compute the spans anew for each sentence
    ranges = F.flatten(F.transform(F.array(spans), lambda held: F.filter(
        F.aggregate(pieces, state, step, lambda acc: acc["all"]), lambda r: F.exists(
            held, lambda s: (s["start"] >= r["start"]) & (s["start"] < r["end"])))))

    def cut(r):
        # one character more on either side tells whether a word is cut
        lo = F.greatest(r["start"] - (reach + 1), F.lit(0))
        hi = r["end"] + (reach + 1)
        wide = F.substring(text, lo + 1, hi - lo)
        wide = F.when(lo > 0, F.regexp_replace(wide, r"^[\p{L}\p{N}]+", "")).otherwise(wide)
        wide = F.when(hi < F.length(text),
                      F.regexp_replace(wide, r"(?<![\p{L}\p{N}])[\p{L}\p{N}]++$", "")).otherwise(wide)
        return F.struct(F.substring(text, r["start"] + 1, r["end"] - r["start"]).alias("own"),
                        wide.alias("around"))
    return F.transform(ranges, cut)


def _evidence(k: Column, draws: Column, share: Column) -> Column:
    """-ln of Hoeffding's bound on the chance of ``k`` hits or more in ``draws`` documents drawn
    without replacement from a corpus with this ``share`` of hits."""
    rest = draws - k
    return k * F.log(k / (draws * share)) + F.when(
        rest > 0, rest * F.log(rest / (draws * F.greatest(1 - share, F.lit(1e-12))))).otherwise(0.0)


def disclosing_terms(docs: DataFrame, spanned: DataFrame, threshold: float, significance: float,
                     reach: int, broadcast_rows: int = 200_000) -> DataFrame:
    """(term): words that disclose some entity; ``spanned`` has doc_id, text and spans.

    A context is the whole sentence of an entity and at least ``reach`` characters on either side
    of it, without base spans. Documents are distinct pairs of doc_id and text: each of m repeated
    rows counts 1 / m, so that counts over all documents are sums which tasks take beforehand.
    """
    key = F.xxhash64("doc_id", "text").alias("doc")
    keys = docs.select(key).groupBy("doc").agg(F.count(F.lit(1)).alias("m"))
    total = float(keys.count())
    again = small(written(keys.where("m > 1").withColumnRenamed("doc", "again"), "pii-repeated"))
    near = (spanned.where("size(spans) > 0")
            .select(key, F.explode(_contexts(F.col("text"), F.col("spans"), reach)).alias("c"))
            .select("doc", "c.own", "c.around")
            .withColumns({"found": base_spans(F.col("own")), "other": base_spans(F.col("around"))})
            .select("doc", F.array_distinct(F.transform("found", lambda s: F.lower(F.substring(
                        F.col("own"), s["start"] + 1, s["end"] - s["start"])))).alias("entities"),
                    F.array_distinct(_words(_replaced(F.col("around"), F.col("other"),
                                                      lambda s: F.lit(" ")))).alias("terms")))
    near = written(near, "pii-contexts")
    said = near.select("doc", "terms", F.explode("entities").alias("entity"))
    entities = said.groupBy("entity").agg(F.countDistinct("doc").alias("n_e"))
    info = F.log2(F.lit(total) / F.col("n_e"))

    def discloses(n_t):
        shared = F.log2(F.lit(total) * F.col("n_te") / (n_t * F.col("n_e")))
        sure = F.greatest(_evidence(F.col("n_te"), F.col("n_e"), n_t / total),
                          _evidence(F.col("n_te"), n_t, F.col("n_e") / total))
        return (info > 0) & (shared >= threshold * info) & (sure >= -math.log(significance))
    pairs = (said.select("doc", "entity", F.explode("terms").alias("term"))
             .groupBy("entity", "term").agg(F.countDistinct("doc").alias("n_te"))
             .join(entities, "entity"))
    # the documents with the term near some entity are a lower bound of n(t)
    there = (near.select("doc", F.explode("terms").alias("term"))
             .groupBy("term").agg(F.countDistinct("doc").alias("n_near")))
    pairs = written(pairs.join(there, "term").where(discloses(F.col("n_near"))), "pii-pairs")
    terms = written(pairs.select("term").distinct(), "pii-candidates")
    if terms.isEmpty():
        return terms
    part = F.lit(1.0) / F.coalesce("m", F.lit(1))
    said_at = (docs.join(again, F.xxhash64("doc_id", "text") == F.col("again"), "left")
               .select(part.alias("part"),
                       F.explode(F.array_distinct(_words(F.col("text")))).alias("term")))
    if terms.count() <= broadcast_rows:
        said_at = said_at.join(F.broadcast(terms), "term", "left_semi")
    counts = said_at.groupBy("term").agg(F.round(F.sum("part")).alias("n_t"))
    return written(pairs.join(counts, "term").where(discloses(F.col("n_t")))
                   .select("term").distinct(), "pii-terms")


def personal_data(docs: DataFrame, threshold: float = 0.9, significance: float = 0.05,
                  reach: int = 40, broadcast_rows: int = 200_000) -> DataFrame:
    """Adds ``spans`` to ``docs`` (doc_id, text and any other columns): base and term spans as
    an array of (start, rank, end, kind), ascending, in code points with exclusive ends.

    Null text has no spans. Rows stay as they are, repeated ones too; a column named ``spans`` is
    replaced. Terms are words of at least three letters or digits, compared in lower case.
    """
    docs = docs.drop("spans")
    found = docs.withColumn("spans", base_spans(F.coalesce(F.col("text").cast("string"),
                                                           F.lit(""))))
    terms = disclosing_terms(docs, found.select("doc_id", "text", "spans"), threshold,
                             significance, reach, broadcast_rows)
    if terms.isEmpty():
        return found
    # the disclosing terms of each document that has some, then their places in its text
    few = terms.count() <= broadcast_rows
    held = (docs.select("doc_id", F.xxhash64("text").alias("version"),
                        F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
            .join(F.broadcast(terms) if few else terms, "term")
            .groupBy("doc_id", "version").agg(F.collect_set("term").alias("terms")))
    held = written(held.withColumnsRenamed({"doc_id": "held_doc", "version": "held_version"}),
                   "pii-held-terms")
    size = held.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.array_join("terms", "")))
                    .alias("bytes"), F.sum(F.size("terms")).alias("terms")).first()
    # 48 bytes a row and 24 a term, beside the terms' own; without it the texts would be shuffled
    if size["n"] and 48 * size["n"] + 24 * size["terms"] + size["bytes"] <= BROADCAST_BYTES:
        held = F.broadcast(held)
    quoted = F.array_join(F.transform("terms", lambda t: F.concat(F.lit("\\Q"), t, F.lit("\\E"))), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), quoted, F.lit(r")(?![\p{L}\p{N}])"))
    more = _marked_spans(F.col("text"), pattern, TERM, len(KINDS), lambda m: F.lit(True))
    return (found.join(held, found["doc_id"].eqNullSafe(held["held_doc"])
                       & (F.xxhash64(found["text"]) == held["held_version"]), "left")
            .select(*[found[c] for c in docs.columns],
                    F.when(F.col("terms").isNotNull(),
                           F.sort_array(F.concat("spans", more)))
                    .otherwise(F.col("spans")).alias("spans")))


def _replaced(text: Column, spans: Column, by) -> Column:
    """The text with each group of overlapping spans replaced by ``by`` of its first."""
    state = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(acc, s):
        return F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.array(
                F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                by(s))).alias("out"))) \
            .otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                                acc["out"].alias("out")))
    return F.aggregate(spans, state, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with each group of overlapping spans replaced by the kind of its first, in
    brackets; text outside spans stays as it is."""
    return _replaced(text, spans, lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
