"""Secret scan: fixed patterns, and values in a credential's place that are costly to guess.

A value that follows a credential's name is taken apart into words, dates, repeats, keyboard
walks and brute-force spans such that the guesses it takes are as few as possible: a dynamic
programme over its characters, linear in its length, in bits (logarithms of guesses to base 2).
Values whose cheapest segmentation still needs many bits are secrets; placeholders such as
``your-password-here`` or ``abcd1234`` are not.

Words are ranked by how often they occur in the whole corpus outside credential values (a
secret that a third of all documents copy must not teach itself); the most frequent ones, a
number of them set by a parameter, go to every task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelift.llm.common import free_name, read_table, text_or_empty
from tunelift.session import materialize

# --- fixed values ---------------------------------------------------------------------
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"     # the same matches as AKIA[A-Z0-9]+ of 18 characters or more
HEX = r"[0-9a-f]{16,}"            # the same matches as [0-9a-f]+ of 16 characters or more
ASSIGN_VALUE = 12
NAMES = (r"pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|secret)[_-]?key"
         r"|credentials?|auth(?:orization)?|bearer")
FOLLOWS = r"""["']?\x20*(?:[:=]|=>|:=)\x20*["']?"""
VALUE = r"""[^\x20\x09-\x0D"'<>,;]{8,}"""
KEY_ROWS = ("`1234567890-=", " qwertyuiop[]\\", " asdfghjkl;'", " zxcvbnm,./")
SEQUENCES = ("abcdefghijklmnopqrstuvwxyz", "0123456789")
LOOKS_LIKE = {"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"}
COMMON = ("password", "pass", "secret", "token", "admin", "root", "user", "test", "example", "sample", "default",
          "changeme", "change", "your", "here", "letmein", "welcome", "login", "dummy", "none", "null", "true", "false",
          "placeholder", "todo", "redacted", "value", "string", "undefined", "monkey", "dragon", "master", "iloveyou")
# --------------------------------------------------------------------------------------
KINDS = ("assign", "access", "hex", "guess")
WORDS = 20_000          # words of the corpus that are ranked
LONGEST_WORD = 16
LONGEST_UNIT = 8        # of a repeat
MIN_BITS = 34.0         # about 10 ** 10 guesses
SPAN_BITS = math.log2(5)  # to tell which of the five kinds a span is
CONTEXT = rf"(?<![A-Za-z])(?:{NAMES}){FOLLOWS}({VALUE})"

_ASSIGN = re.compile(ASSIGN, re.I | re.A)
_ACCESS, _HEX = re.compile(ACCESS), re.compile(HEX)
_CONTEXT = re.compile(CONTEXT, re.I | re.A)
# what a text must have to be looked at in Python
_HINT = rf"(?i:(?:password|passwd|secret|token|api_?key|{NAMES})[\"']?\x20*[:=])|AKIA[A-Z0-9]{{14}}|[0-9a-f]{{16}}"
_DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?"
                   r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d"
                   r"|(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\3(?:19|20)\d\d", re.A)


def _neighbours() -> dict[tuple[str, str], tuple[int, int]]:
    """Direction of the step from one key to an adjacent one, or along a sequence."""
    at = {c: (r, k) for r, row in enumerate(KEY_ROWS) for k, c in enumerate(row) if c != " "}
    out = {(a, b): (at[b][0] - at[a][0], at[b][1] - at[a][1]) for a in at for b in at
           if a != b and abs(at[a][0] - at[b][0]) <= 1 and abs(at[a][1] - at[b][1]) <= 1}
    for row in SEQUENCES:
        out |= {(a, b): (2, 1) for a, b in zip(row, row[1:])} | {(b, a): (2, -1) for a, b in zip(row, row[1:])}
    return out


STEPS = _neighbours()
KEYS = sum(len(r.strip()) for r in KEY_ROWS)


def char_bits(c: str) -> float:
    """Bits of a character by the size of its class."""
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log2(26)
    return math.log2(10) if "0" <= c <= "9" else math.log2(33 if c < "\x80" else 100)


def _case_bits(word: str) -> float:
    """Bits of the capitals of a word: none, all or the first one are cheap."""
    up = sum(c.isupper() for c in word)
    if not up:
        return 0.0
    if up == len(word) or (up == 1 and word[0].isupper()):
        return 1.0
    return math.log2(sum(math.comb(len(word), k) for k in range(1, min(up, len(word) - up) + 1)) + 1)


def _repeat_ends(value: str) -> list[np.ndarray]:
    """For each length of a unit: how often the unit that starts at a character follows itself."""
    codes = np.frombuffer(value.encode("utf-32-le"), dtype=np.uint32)
    out = []
    for n in range(1, min(LONGEST_UNIT, len(codes) // 2) + 1):
        differs = np.r_[codes[:-n] != codes[n:], np.ones(n, dtype=bool)]
        stop = np.where(differs, np.arange(len(codes)), len(codes))
        run = np.minimum.accumulate(stop[::-1])[::-1] - np.arange(len(codes))
        out.append(run // n + 1)
    return out


def _walk_ends(value: str) -> list[tuple[int, int]]:
    """(end, turns) of the longest keyboard walk from each character."""
    low, out = [c.lower() for c in value], [(len(value), 0)] * len(value)
    steps = [STEPS.get((a, b)) for a, b in zip(low, low[1:])] + [None]
    for i in range(len(value) - 1, -1, -1):
        if steps[i] is None:
            out[i] = (i + 1, 0)
        else:
            end, turns = out[i + 1]
            out[i] = (end, turns + (steps[i + 1] is not None and steps[i + 1] != steps[i]))
    return out


def spans(value: str, ranks: Mapping[str, int]) -> Iterator[tuple[int, int, str, float]]:
    """(start, end, kind, bits) of the words, dates, repeats and walks, by start."""
    plain = "".join(LOOKS_LIKE.get(c, c.lower() if len(c.lower()) == 1 else c) for c in value)
    repeats, walks = _repeat_ends(value), _walk_ends(value)
    for i in range(len(value)):
        for end in range(i + 3, min(i + LONGEST_WORD, len(value)) + 1):
            rank = ranks.get(plain[i:end])
            if rank:
                looks = sum(c in LOOKS_LIKE for c in value[i:end])
                yield i, end, "word", math.log2(rank) + _case_bits(value[i:end]) + looks
        found = _DATE.match(value, i) if value[i] in "0123" else None
        if found:
            n = found.end() - i
            yield i, found.end(), "date", math.log2(200) if n == 4 else math.log2(200 * 365) + (n > 8) * 2
        for n, times in enumerate(repeats, 1):
            if times[i] > 1 and n * times[i] > 2:
                unit = value[i:i + n]
                bits = min(sum(map(char_bits, unit)), math.log2(ranks.get(unit.lower(), 2 ** 60)) + _case_bits(unit))
                yield i, i + n * int(times[i]), "repeat", bits + math.log2(int(times[i]))
        end, turns = walks[i]
        if end - i > 2:
            yield i, end, "walk", math.log2(KEYS) + math.log2(end - i) + turns * math.log2(5)


def segmented(value: str, ranks: Mapping[str, int]) -> tuple[float, list[tuple[int, int, str]]]:
    """Bits and spans of the segmentation of ``value`` that takes the fewest guesses.  Characters
    outside other spans form brute-force spans, each character at the bits of its class; every
    span costs SPAN_BITS besides."""
    n = len(value)
    best, rough = [math.inf] * (n + 1), [math.inf] * (n + 1)   # rough: the last span is brute force
    best[0] = 0.0
    come: list[tuple[int, str]] = [(0, "")] * (n + 1)
    began = [0] * (n + 1)
    found = spans(value, ranks)
    span = next(found, None)
    for i in range(n):
        while span and span[0] == i:
            _, end, kind, bits = span
            if best[i] + SPAN_BITS + bits < best[end]:
                best[end], come[end] = best[i] + SPAN_BITS + bits, (i, kind)
            span = next(found, None)
        fresh = best[i] + SPAN_BITS
        began[i + 1] = i if fresh < rough[i] else began[i]
        rough[i + 1] = min(fresh, rough[i]) + char_bits(value[i])
        if rough[i + 1] < best[i + 1]:
            best[i + 1], come[i + 1] = rough[i + 1], (began[i + 1], "brute")
    out, at = [], n
    while at:
        out.append((come[at][0], at, come[at][1]))
        at = come[at][0]
    return best[n], out[::-1]


def secrets(text: str, ranks: Mapping[str, int], min_bits: float = MIN_BITS) -> list[tuple[str, int, int, str, float | None]]:
    """(kind, start, end, what is there, bits of a guessed value) by start and kind."""
    found = [("assign", *m.span(), m[0], None) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    found += [(kind, *m.span(), m[0], None) for kind, p in (("access", _ACCESS), ("hex", _HEX)) for m in p.finditer(text)]
    for m in _CONTEXT.finditer(text):
        value = m[1].rstrip(".:!?)]}")
        bits = segmented(value, ranks)[0]
        if bits >= min_bits:
            found.append(("guess", m.start(1), m.start(1) + len(value), value, bits))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def word_ranks(docs: DataFrame, words: int = WORDS) -> dict[str, int]:
    """Rank of the common words and of the most frequent words (3 to 16 letters, lower case) of
    all ``docs`` (text) outside credential values; ties by word.  The driver gets ``words`` rows."""
    text = F.lower(F.regexp_replace(text_or_empty(), f"(?i){CONTEXT}", " "))
    counts = (docs.select(F.explode(F.regexp_extract_all(text, F.lit(rf"(\p{{L}}{{3,}})"))).alias("word"))
              .where(F.length("word") <= LONGEST_WORD).groupBy("word").count())
    # stored first: a collected limit would send every task's own best words to the driver
    best = materialize(counts.orderBy(F.desc("count"), "word").limit(words), "word-ranks")
    top = [r["word"] for r in sorted(best.collect(), key=lambda r: (-r["count"], r["word"]))]
    ranks: dict[str, int] = {}
    for word in [*COMMON, *top]:
        ranks.setdefault(word, len(ranks) + 1)
    return ranks


FOUND = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("value", T.StringType()), T.StructField("bits", T.DoubleType())]))


def find_secrets(docs: DataFrame, ranks: Mapping[str, int], min_bits: float = MIN_BITS,
                 keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a column ``secrets``: kind, start and end (code points, end exclusive), value
    and bits of each span, by start, then in the order of KINDS.  ``keep`` names the columns that
    stay (default: all; one called ``secrets`` is replaced).

    Null and empty texts have none; repeated rows and null ids are scanned like others.  Whole
    texts are scanned, and time grows with their length alone, as it does for long values."""
    keep = [c for c in (keep or docs.columns) if c != "secrets"]
    shared = docs.sparkSession.sparkContext.broadcast(dict(ranks))
    text_at = len(keep)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias(free_name(keep, "scanned")))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("value", pa.string()), ("bits", pa.float64())]))
    names = ("kind", "start", "end", "value", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            texts = b.column(text_at)
            hint = pc.fill_null(pc.match_substring_regex(texts, _HINT), False).to_numpy(zero_copy_only=False)
            found: list[list[dict]] = [[] for _ in range(b.num_rows)]
            for i in np.flatnonzero(hint).tolist():
                found[i] = [dict(zip(names, s)) for s in secrets(texts[i].as_py(), known, min_bits)]
            yield pa.record_batch([*[b.column(i) for i in range(text_at)], pa.array(found, kind)], names=[*keep, "secrets"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("secrets", FOUND)]))


def op13_secret_scan(spark, sf_dir):
    """Secrets in all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, word_ranks(docs), keep=["doc_id"])

    def number(kind: str) -> F.Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(rows: F.Column) -> F.Column:
        return F.concat_ws(",", F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                        s["end"].cast("string"))))

    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return found.select("doc_id", *[number(k) for k in KINDS[:3]], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("secrets")).alias("spans"), number("guess"))
