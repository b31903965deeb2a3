"""I-Match fingerprints with randomised lexicons (DataFrame functions only).

The lexicon is every term whose document frequency lies in a chosen band, so whose inverse
document frequency does.  Its size has a bound that does not grow with the corpus: a term of
the band is in at least ``min_share`` of the distinct texts, so there are at most (mean distinct
terms of a text) / min_share of them; that bound is what lets the lexicon be broadcast.
Each term of the lexicon carries a random mask that says to which of 56 subsets it belongs;
subsets come in seven densities, from a quarter of the lexicon down to 1/256 (each a random half
of the one before it), so short and long texts both have subsets that an edit leaves alone.  A fingerprint is, for each subset, the
hash of the text's distinct terms in it, sorted (by their own hash).

Documents are also compared with an edited copy and with the next document by doc_id.  For
that, ids are dealt into ranges of about RANGE_ROWS; a range is a window, and the first
document of the following range is added to it, so no window spans the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunelift.llm.common import read_table, text_or_empty
from tunelift.session import materialize

MIN_SHARE, MAX_SHARE = 0.002, 0.2   # of the distinct texts that have a term of the lexicon
FIRST_DENSITY, DENSITIES, PER_DENSITY = 2, 7, 8  # 1/4, 1/8, ... 1/256 of the lexicon; 8 subsets each
SUBSETS = DENSITIES * PER_DENSITY
RANGE_ROWS = 512
BROADCAST_TERMS = 1_000_000
TERM = r"[\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _mask(term: Column, seed: int) -> Column:
    """A long whose bit PER_DENSITY * d + j says that the term is in subset j of density d.
    Each subset is a random half of the one of the density before it."""
    out, kept = F.lit(0).cast("long"), None
    for halving in range(FIRST_DENSITY + DENSITIES - 1):
        random = F.xxhash64(term, F.lit(seed), F.lit(halving)).bitwiseAND(F.lit((1 << PER_DENSITY) - 1))
        kept = random if kept is None else kept.bitwiseAND(random)
        if (d := halving - FIRST_DENSITY + 1) >= 0:
            out = out.bitwiseOR(F.shiftleft(kept, d * PER_DENSITY))
    return out


def lexicon(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE,
            seed: int = 11) -> DataFrame:
    """(term, id, mask) of the terms in the band; frequencies count all distinct texts, so
    copies of a text neither raise its terms above the band nor change it for others.

    A term in one text only is no evidence and is left out; where ``min_share`` of a
    small table is less than two texts, two are asked for."""
    hashed = docs.select(text_or_empty().alias("text")).withColumn("hash", F.xxhash64("text"))
    rows = hashed.select("hash").distinct().count()
    texts = hashed.groupBy("hash").agg(F.first("text").alias("text"))
    counts = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").count()
    return materialize(
        counts.where(F.col("count").between(max(2, min_share * rows), max(2, max_share * rows)))
        .select("term", F.xxhash64("term", F.lit(seed)).alias("id"), _mask(F.col("term"), seed).alias("mask")),
        "lexicon")


def _with_print(df: DataFrame, found: str, text_hash: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of the sorted terms ``found`` (array of id, mask): eight
    hexadecimal digits for each subset (``-`` for one without a term), joined by dots.  A text
    without any term of the lexicon is told by its own hash.

    A subset is filtered from the one of the density before it, so that all of them together
    look at each term about eleven times."""
    def member(k: int):
        return lambda t: t["mask"].bitwiseAND(F.lit(1 << k).cast("long")) != 0

    cols = df.columns
    for d in range(DENSITIES):
        df = df.select("*", *[F.filter(f"{found}_{d - 1}_{j}" if d else found, member(d * PER_DENSITY + j))
                              .alias(f"{found}_{d}_{j}") for j in range(PER_DENSITY)])

    def digits(d: int, j: int) -> Column:
        inside = F.col(f"{found}_{d}_{j}")
        h = F.xxhash64(F.transform(inside, lambda t: t["id"]), F.lit(d * PER_DENSITY + j))
        return F.when(F.size(inside) > 0, F.lower(F.lpad(F.hex(F.pmod(h, F.lit(1 << 32))), 8, "0"))).otherwise("-")

    parts = F.concat_ws(".", *[digits(d, j) for d in range(DENSITIES) for j in range(PER_DENSITY)])
    return df.select(*cols, F.when(F.size(found) > 0, parts).otherwise(F.concat(F.lit("text:"), F.col(text_hash))).alias(name))


def likeness(a: str, b: str) -> Column:
    """Share of equal hashes among the subsets of which either column's print has a term,
    0 to 1; equal prints have likeness 1, a print without a term and another one 0."""
    x, y = F.split(a, "[.]"), F.split(b, "[.]")
    both = F.zip_with(x, y, lambda p, q: F.when((p != "-") | (q != "-"), F.when(p == q, 1).otherwise(0)))
    some = F.filter(both, lambda v: v.isNotNull())
    share = F.aggregate(some, F.lit(0), lambda s, v: s + v) / F.greatest(F.size(some), F.lit(1))
    return (F.when(F.col(a) == F.col(b), 1.0)
            .when(F.col(a).startswith("text:") | F.col(b).startswith("text:"), 0.0).otherwise(share))


def ranges(docs: DataFrame, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows, guests): documents (doc_id, text) with the number of their range, and for each
    range the first document after it (after the last: the first of all).

    Ranges are equal stretches of ids, about ``range_rows`` documents each where ids are
    evenly spread.  The chain of ranges is followed in three levels of windows, the last over
    (rows / range_rows^2) rows."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).where("doc_id is not null")
    stat = base.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if not stat["n"]:
        return base.withColumn("range", F.lit(0).cast("long")), base.withColumn("range", F.lit(0).cast("long"))
    width = max(1, -(-(stat["hi"] - stat["lo"] + 1) * range_rows // stat["n"]))
    in_range = base.withColumn("range", F.expr(f"cast(floor((cast(doc_id as decimal(20,0)) - {stat['lo']}) / {width}) as long)"))
    firsts = in_range.groupBy("range").agg(F.min("doc_id").alias("first"))
    wide = F.floor(F.col("range") / range_rows)
    heads = firsts.groupBy(wide.alias("wide")).agg(F.min(F.struct("range", "first")).alias("head"))
    after_wide = heads.select("wide", F.lead("head.first").over(W.orderBy("wide")).alias("beyond"))
    chain = (firsts.withColumn("wide", wide).join(after_wide, "wide")
             .select("range", F.coalesce(F.lead("first").over(W.partitionBy("wide").orderBy("range")), "beyond",
                                         F.lit(stat["lo"])).alias("next_id")))
    chain = materialize(chain, "range-chain")
    guests = (base.join(chain.select("range", F.col("next_id").alias("doc_id")), "doc_id")
              .select("doc_id", "text", "range"))
    return in_range, guests


def imatch(docs: DataFrame, lex: DataFrame | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of documents, of an edited copy, and their likeness.

    Input columns doc_id and text (others are ignored).  The edited copy replaces the last
    floor(n_chars / 2) code points by the first as many (or all) of the next document in
    ascending doc_id; the first follows the last.  Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    Null text counts as empty.  Rows that repeat a doc_id are ordered by text.  A single row
    is its own next document.  A row without doc_id is in no order: its copy only loses its
    end, and near_next is 0 (1 if its text is empty).  An empty table gives an empty result."""
    lex = lexicon(docs) if lex is None else lex
    rows, guests = ranges(docs, range_rows)
    lost = docs.where("doc_id is null").select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
        F.pmod(F.xxhash64(text_or_empty()), F.lit(1 << 20)).alias("range"))
    everything = (rows.select("doc_id", "text", "range", F.lit(0).alias("kind"))
                  .unionByName(guests.select("doc_id", "text", "range", F.lit(1).alias("kind")))
                  .unionByName(lost.select("doc_id", "text", "range", F.lit(2).alias("kind"))))
    order = W.partitionBy("range").orderBy("kind", "doc_id", "text")
    lone = F.col("kind") == 2
    after = F.when(lone, F.lit("")).otherwise(F.coalesce(F.lead("text").over(order), F.lit("")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                      F.substring("next_text", F.lit(1), half))
    pairs = (everything.withColumn("place", F.row_number().over(order)).withColumn("next_text", after)
             .withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", edited)
             .select("range", "place", "kind", "doc_id", "n_chars", "text", "edited"))
    # a header for the row, then the terms of both texts; all are gathered again within the
    # range, so neither the look-up nor the gathering moves a row
    def tagged(c: str, of: int) -> Column:
        return F.transform(terms(F.col(c)), lambda t: F.struct(F.lit(of).alias("of"), t.alias("term")))

    header = F.array(F.struct(F.lit(-1).alias("of"), F.lit(None).cast("string").alias("term")))
    exploded = pairs.select("range", "place", "kind", "doc_id", "n_chars", F.sha2("text", 256).alias("sha"),
                            F.sha2("edited", 256).alias("edited_sha256"),
                            F.explode(F.concat(header, tagged("text", 0), tagged("edited", 1))).alias("x"))
    head = F.col("x.of") == -1
    facts = ["kind", "doc_id", "n_chars", "sha", "edited_sha256"]
    exploded = exploded.select("range", "place", *[F.when(head, F.col(c)).alias(c) for c in facts], "x.of", "x.term")
    # the bound above holds the lexicon under about 150,000 terms; where it does not, shuffle
    few = lex.count() <= BROADCAST_TERMS
    found = (exploded.join(F.broadcast(lex) if few else lex, "term", "left")
             .where((F.col("of") == -1) | F.col("id").isNotNull()))
    gathered = found.groupBy("range", "place").agg(*[F.max(c).alias(c) for c in facts], *[
        F.array_sort(F.collect_list(F.when(F.col("of") == of, F.struct("id", "mask")))).alias(name)
        for of, name in ((0, "own"), (1, "other"))])
    prints = _with_print(_with_print(gathered, "own", "sha", "fingerprint"), "other", "edited_sha256", "edited_fingerprint")
    prints = prints.select("range", "place", *facts, "fingerprint", "edited_fingerprint")
    # a lone row has no next document; its likeness to an empty text is that of its own print
    empty = F.concat(F.lit("text:"), F.sha2(F.lit(""), 256))
    compared = prints.withColumn("next_print", F.when(lone, empty).otherwise(
        F.lead("fingerprint").over(W.partitionBy("range").orderBy("place"))))

    return (compared.where("kind <> 1")
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                    likeness("fingerprint", "next_print").alias("near_next")))


def op3_imatch_fingerprints(spark, sf_dir):
    """Fingerprints of all documents and of their edited copies."""
    return imatch(read_table(spark, sf_dir, "documents"))
