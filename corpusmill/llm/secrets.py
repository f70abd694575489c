"""Secrets in texts: fixed forms, and runs of characters that pass a battery of randomness tests.

All work is SQL expressions on the row that holds the text. The battery takes each long run of
token characters, infers its encoding from the characters it uses, and tests it against a uniform
choice from that alphabet: chi-squared for how often common and other letters, small and large, and digits occur,
runs of small letters, large letters and digits, and lag-one serial correlation of places in the alphabet.
The three p-values combine by Fisher's rule; a large one means that the run looks random.

What looks random by chance is not a secret, and short runs of any kind often do. So discoveries are
controlled against natural tokens: the corpus' own words, drawn by digest and joined as identifiers, paths and slugs
are, go through the same battery. For each class of length the Benjamini-Hochberg step-up rule reports the runs that
look more random than natural tokens do, so that about a share ``rate`` of them at most is natural. A run that the
battery rejects at ``LEAST_P`` is never reported. Counts of p-values in fixed bins are all that reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import fresh

KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"        # the same matches as AKIA[A-Z0-9]+ of 20 characters and more
HEX = r"[0-9a-f]{24,}"               # the same as [0-9a-f]+ of 24 and more
LEAST_ASSIGNED = 6
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
LENGTH_CLASSES = (20, 28, 40, 64, 128)
STEPS = 50                           # bins for each power of ten of p
MOST_BINS = 1000
LEAST_P = 1e-3                       # of the battery, for a run to be reported
WORDS_JOINED = (3, 5, 8, 14, 26)     # words, on average, of natural tokens
LEAST_DRAWS = 20_000                 # draws of words; a small vocabulary is drawn from again

_DIGITS, _SMALL, _LARGE = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COMMON = "aeinorst"                 # letters that natural words prefer
_SYMBOLS = "+/-_"
# (pattern of the whole run, alphabet in order), first match counts
ENCODINGS = (
    ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+$", _LARGE + "234567"),
    ("^[0-9a-z]+$", _DIGITS + _SMALL),
    ("^[0-9A-Z]+$", _DIGITS + _LARGE),
    ("^[0-9A-Za-z]+$", _LARGE + _SMALL + _DIGITS),
    ("^[0-9A-Za-z+/]+$", _LARGE + _SMALL + _DIGITS + "+/"),
    ("^[0-9A-Za-z_-]+$", _LARGE + _SMALL + _DIGITS + "-_"),
    ("", _LARGE + _SMALL + _DIGITS + "+/-_"))


def _cell(c: str) -> int:
    """Common and other small letters, common and other large ones, and all else."""
    if not c.isalpha():
        return 4
    return 2 * c.isupper() + (c.lower() not in _COMMON)


_EVERY = _SMALL + _LARGE + _DIGITS + _SYMBOLS
_CELLS = "".join(str(_cell(c)) for c in _EVERY)


def encoding_facts(alphabet: str) -> tuple[list[float], float, float]:
    """Shares of the cells; chance that neighbours differ in kind, and covariance of two such events in a row."""
    shares = [sum(_cell(c) == k for c in alphabet) / len(alphabet) for k in range(5)]
    kinds = [shares[0] + shares[1], shares[2] + shares[3], shares[4]]
    s2, s3 = (sum(x ** k for x in kinds) for k in (2, 3))
    return shares, 1 - s2, s3 - s2 * s2


_SPAN = "array<struct<start: bigint, kind: int, end: bigint, token: string>>"


def found(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches, whose ``group`` has ``least`` characters.

    The pieces between the matches and the matches themselves tile the text, so running lengths
    are code point positions.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    tiles = F.zip_with(
        F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole)), whole,
                   lambda piece, match: F.struct(F.length(piece).cast("long").alias("skip"), match.alias("match"))),
        value, lambda t, v: F.struct(t["skip"].alias("skip"), t["match"].alias("match"), v.alias("value")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(acc, t):
        begin = acc["at"] + t["skip"]
        end = begin + F.length(t["match"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), t["match"].alias("token"))
        keep = F.length(t["value"]) >= least
        return F.struct(end.alias("at"), F.when(keep, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))
    spans = F.aggregate(tiles, start, step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _upper_tail(z: Column) -> Column:
    """1 - Phi(z), by the classical rational approximation (error below 1e-7 of the body)."""
    def tail(z, a, t):
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        above = F.exp(-a * a / 2) * 0.3989422804014327 * poly
        return _let(above, lambda x: F.when(z >= 0, x).otherwise(1 - x))
    return _let(z, lambda z: _let(F.abs(z), lambda a: _let(1 / (1 + 0.2316419 * a), lambda t: tail(z, a, t))))


def randomness(token: Column) -> Column:
    """p-value of the battery for a run of token characters; small means not random.

    Every value that is used more than once is bound, so that the expression stays small.
    """
    facts = F.array(*[
        F.struct(F.lit(letters).alias("alphabet"), F.array(*map(F.lit, shares)).alias("shares"),
                 F.lit(turns).alias("turns"), F.lit(twice).alias("twice"))
        for _, letters in ENCODINGS for shares, turns, twice in [encoding_facts(letters)]])

    def tested(body):
        number = F.lit(len(ENCODINGS))
        for i, (pattern, _) in reversed(list(enumerate(ENCODINGS[:-1]))):
            number = F.when(body.rlike(pattern), F.lit(i + 1)).otherwise(number)
        return _let(F.element_at(facts, number), lambda e: _let(_uniformity(body, e), lambda u: _let(
            _runs(body, e), lambda r: _let(_serial(body, e["alphabet"]), lambda c: _fisher(u, r, c)))))
    return _let(F.regexp_replace(token, "=+$", ""), tested)


def _cells(body: Column) -> Column:
    return F.translate(body, _EVERY, _CELLS)


def _uniformity(body: Column, e: Column) -> Column:
    """Chi-squared over the cells that the alphabet has (Wilson-Hilferty)."""
    def squares(cells, n):
        def add(total, j):
            count = (n - F.length(F.replace(cells, j.cast("string"), F.lit("")))).cast("double")
            return _let(n * F.get(e["shares"], j), lambda wanted: F.when(
                wanted > 0, total + F.pow(count - wanted, F.lit(2.0)) / wanted).otherwise(total))
        return F.aggregate(F.sequence(F.lit(0), F.lit(4)), F.lit(0.0), add)

    def tail(x):
        free = F.size(F.filter(e["shares"], lambda s: s > 0)).cast("double") - 1
        return _let(free, lambda k: _let(F.lit(2.0) / (9 * k), lambda v: _upper_tail(
            (F.pow(x / k, F.lit(1 / 3)) - (1 - v)) / F.sqrt(v))))
    return _let(_cells(body), lambda cells: _let(squares(cells, F.length(body)), tail))


def _runs(body: Column, e: Column) -> Column:
    """Runs of small letters, of large letters, and of all else."""
    kinds = F.translate(_cells(body), "01234", "aabbc")
    n = F.length(body).cast("double")
    turns = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1
    spread = (n - 1) * e["turns"] * (1 - e["turns"]) + 2 * (n - 2) * e["twice"]
    return _two_sided((turns - (n - 1) * e["turns"]) / F.sqrt(spread))


def _neighbours(at: Column) -> Column:
    return F.filter(F.transform(at, lambda x, i: F.struct(x.alias("x"), F.get(at, i + 1).alias("y"))), lambda p: p["y"].isNotNull())


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z)))


def _serial(body: Column, alphabet: Column) -> Column:
    """Lag-one serial correlation of places in the alphabet, against the mean and variance of a uniform choice."""
    places = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: (F.instr(alphabet, c) - 1).cast("double"))

    def p(at, size):
        products = F.aggregate(_neighbours(at), F.lit(0.0), lambda a, p: a + (p["x"] - (size - 1) / 2) * (p["y"] - (size - 1) / 2))
        return _two_sided(products / ((size * size - 1) / 12 * F.sqrt(F.size(at) - 1)))
    return _let(places, lambda at: _let(F.length(alphabet).cast("double"), lambda size: p(at, size)))


def _fisher(*p: Column) -> Column:
    logs = sum((F.log(F.greatest(x, F.lit(1e-30))) for x in p), F.lit(0.0))
    return _let(logs, lambda x: F.exp(x) * (1 - x + x * x / 2))


def _length_class(token: Column) -> Column:
    return sum((F.when(F.length(token) >= x, 1).otherwise(0) for x in LENGTH_CLASSES), F.lit(0))


def _mixed(token: Column) -> Column:
    """Whether a run could be a key: letters and digits, or changing case."""
    return (token.rlike("[0-9]") & token.rlike("[A-Za-z]")) | token.rlike("[a-z][A-Z].*[a-z][A-Z]")


def _body(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))


def _tested(token: Column) -> list[Column]:
    return [_length_class(token).alias("length_class"), _bin(randomness(token)).alias("bin")]


def scanned(docs: DataFrame, text: str, base: str, tested: str) -> DataFrame:
    """``docs`` with spans of the base kinds and tested candidates (span, class of length, bin of the p-value)."""
    body = _body(text)
    spans = F.array_sort(F.concat(found(body, ASSIGN, 0, 2, LEAST_ASSIGNED), found(body, ACCESS, 1), found(body, HEX, 2)))
    docs = docs.withColumn(base, spans)
    free = F.filter(found(body, CANDIDATE, 3), lambda c: _mixed(c["token"]) & ~F.exists(
        base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return docs.withColumn(tested, F.transform(free, lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), *_tested(c["token"]))))


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * STEPS), F.lit(MOST_BINS)).cast("int")


def natural_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """``token``: words of all texts, drawn by digest and joined as identifiers, paths and slugs are.

    Words within long runs of token characters don't count, as those may be secrets. Every different word is drawn once
    for each length in ``WORDS_JOINED``, and again if the vocabulary is small.
    """
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower(F.regexp_replace(_body(text), CANDIDATE, " ")), F.lit("[a-z]{2,12}"), F.lit(0)))).alias("word")).distinct()
    size = words.agg(F.count("*").alias("size"))                          # one row
    again = F.ceil(F.lit(LEAST_DRAWS) / F.col("size")).cast("int")
    drawn = words.crossJoin(F.broadcast(size)).select(
        "word", F.greatest(again * F.col("size"), F.lit(1)).alias("draws"), F.explode(F.sequence(F.lit(1), again)).alias("turn"))
    drawn = drawn.select("word", "turn", "draws", F.explode(F.array(*map(F.lit, WORDS_JOINED))).alias("joined"))
    bucket = F.pmod(F.xxhash64("word", "turn", "joined"), F.ceil(F.col("draws") / F.col("joined")))
    groups = drawn.groupBy("joined", bucket.alias("bucket")).agg(
        F.array_sort(F.collect_list(F.struct(F.xxhash64("turn", "word").alias("h"), "word"))).alias("w"))
    groups = groups.select(F.transform("w", lambda x: x["word"]).alias("w"), F.xxhash64("joined", "bucket").alias("h"))
    big = F.transform("w", lambda x: F.initcap(x))
    number = F.pmod(F.shiftright("h", 8), F.lit(2100)).cast("string")
    inner = F.transform("w", lambda x, i: F.when(i % 3 == 1, F.concat(x, number)).otherwise(x))
    styles = F.array(
        F.array_join(big, ""), F.concat(F.array_join(F.slice("w", 1, 1), ""), F.array_join(F.slice(big, F.lit(2), F.size("w")), "")),
        F.concat(F.array_join(big, ""), number), F.concat_ws("_", "w", number), F.concat_ws("-", "w", number),
        F.concat_ws("/", "w", number), F.concat_ws("_", F.transform("w", F.upper), number), F.array_join(big, "-"),
        F.array_join(inner, "-"), F.array_join(inner, "/"), F.array_join(inner, ""), F.array_join(big, "/"))
    first = F.pmod("h", F.lit(6)).cast("int")
    tokens = groups.select(F.explode(F.array(F.get(styles, first), F.get(styles, first + 6))).alias("token"))
    return tokens.where((F.length("token") >= 20) & _mixed(F.col("token")))


def _counts(rows: DataFrame) -> dict[int, dict[int, int]]:
    """{class of length: {bin: rows}}; a few numbers per class."""
    out: dict[int, dict[int, int]] = {}
    for r in rows.groupBy("length_class", "bin").count().collect():
        out.setdefault(r["length_class"], {})[r["bin"]] = r["count"]
    return out


def discovered_bins(tested: dict, natural: dict, rate: float) -> dict[int, int]:
    """For each class of length the last bin (of falling p) that the step-up rule reports.

    The p-value of a run is the share of natural tokens that look as random or more, itself counted.
    """
    out = {}
    least = int(-math.log10(LEAST_P) * STEPS)
    for c, bins in tested.items():
        null, total = natural.get(c, {}), sum(bins.values())
        among, upto, below = 1 + sum(null.values()), 0, 0
        for b in range(least):
            upto += bins.get(b, 0)
            below += null.get(b, 0)
            if bins.get(b) and (1 + below) / among * total <= rate * upto:
                out[c] = b
    return out


def find_secrets(docs: DataFrame, text: str = "text", rate: float = 0.01) -> DataFrame:
    """``docs`` with ``secrets``: array of (start, kind, end), by start and kind, in code points.

    ``kind`` is a place in ``KINDS``; ends are exclusive. Base kinds are always there; a ``random``
    span overlaps none of them. A null text has no secrets. Rows are independent but for the
    thresholds, so repeated rows have equal results; an existing column ``secrets`` is replaced. A table without
    words has nothing to compare with and no ``random`` spans.
    """
    docs = docs.drop("secrets")
    base, tested = fresh(docs, "_base", "_tested")
    found = scanned(docs, text, base, tested)
    natural = natural_tokens(docs, text).select(*_tested(F.col("token")))
    runs = found.select(F.explode(tested).alias("t")).select("t.length_class", "t.bin")
    last = discovered_bins(_counts(runs), _counts(natural), rate)
    limits = F.array(*[F.lit(last.get(c, -1)) for c in range(len(LENGTH_CLASSES) + 1)])
    kept = F.filter(tested, lambda t: t["bin"] <= F.get(limits, t["length_class"]))
    plain = [F.transform(x, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
             for x in (F.col(base), kept)]
    return found.withColumn("secrets", F.array_sort(F.concat(*plain))).drop(base, tested)


def named_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span replaced; overlapping spans share one mask."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"]).alias("out"))
    rest = F.aggregate(spans, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)
