"""Secret scans with column functions only: fixed patterns, and entropy over sliding windows of candidate strings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the base patterns, their least lengths and the order of the kinds
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# runs are maximal, so the least length may stand in the pattern: a shorter run holds no match either way
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST = {"assign": 6, "access": 20, "hex": 24}

# candidates of the entropy scan, one pattern per character class, and the classes' thresholds in bits per character
ONE_CASE = (
    r"(?<![0-9A-Za-z+/_-])(?=[0-9A-Za-z+/_-]*[0-9])(?=[0-9A-Za-z+/_-]*[{case}])(?![0-9A-Fa-f]+(?![0-9A-Za-z+/_-]))"
    r"[0-9{case}+/_-]{{20,}}={{0,6}}(?![0-9A-Za-z+/_-])"
)
CLASSES = {
    "ehex": (r"(?<![0-9A-Za-z])(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{20,}(?![0-9A-Za-z])", "0123456789abcdef", 2.8),
    "ebase": (
        r"(?<![0-9A-Za-z+/_-])(?=[0-9A-Za-z+/_-]*[a-z])(?=[0-9A-Za-z+/_-]*[A-Z])"
        r"[0-9A-Za-z+/_-]{20,}={0,2}(?![0-9A-Za-z+/_-])",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=", 3.6,
    ),
    # 20 random characters of 36 stay below 3.3 bits in less than 1 % of cases
    "elower": (ONE_CASE.format(case="a-z"), "abcdefghijklmnopqrstuvwxyz0123456789+/_-=", 3.3),
    "eupper": (ONE_CASE.format(case="A-Z"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-=", 3.3),
}
WINDOW = 20  # characters of a window
SPAN = 60  # characters whose windows are looked at together
# in a candidate of one letter case with separators, letters and digits touch this often; words and dates of a path hardly do
TOUCH, TOUCHES = r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])", 3
# in names of both cases small letters follow small letters; in random strings hardly a quarter of all neighbours are such
SMALL, SMALL_PART = r"(?<=[a-z])[a-z]", 0.47
# a candidate with so many of these is a path, whose parts are judged by themselves
PATH, PATH_MARKS = "/", 2
# windows over these words are no secrets, whatever else the candidate holds
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|changeme|test[_-]?key|lorem|"
    r"abcdef(?:ghijkl(?:mnopqr(?:stuvwx(?:yz)?)?)?)?|0?12345678|0123456"
)
# whole candidates that are no secrets: identifiers of fixed shape, digests that are named as such, a vendor's example
SHAPES = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|"
    r"^(sha[0-9]+|md5)[-_]([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|"
    r"([0-9a-z+/_-]{22}|[0-9a-z+/_-]{27}|[0-9a-z+/_-]{38}|[0-9a-z+/_-]{43}|[0-9a-z+/_-]{64}|[0-9a-z+/_-]{86})={0,2})$|"
    r"^wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY$"
)
BLOCK = 256  # matches whose positions are added up together


def _length(c: Column) -> Column:
    return F.length(c).cast("long")


def _found(text: Column, pattern: str, kind: str, body: int, least: int) -> Column:
    """Array of `(start, order, kind, end, word)`: leftmost non-overlapping matches of `pattern` in code points.

    Matches whose group `body` has fewer than `least` characters are left out after they have taken their place. The text is cut at the
    matches, so a position is the sum of the lengths before it; sums run over blocks of matches first, then
    within a block, so many matches in one text take linear memory and nearly linear time.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(body))
    gaps = F.split(text, pattern, -1)
    order = list(LEAST).index(kind) if kind in LEAST else len(LEAST) + list(CLASSES).index(kind)
    empty = F.array().cast("array<struct<start: long, ord: int, kind: string, end: long, word: string>>")

    def with_positions(matches: Column, bodies: Column, cuts: Column) -> Column:
        rows = F.arrays_zip(
            matches.alias("m"), bodies.alias("b"), F.slice(cuts, F.lit(1), F.size(matches)).alias("g")
        )
        blocks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK).cast("int"))
        cut = F.transform(blocks, lambda i: F.slice(rows, i * BLOCK + 1, F.lit(BLOCK)))
        spent = lambda r: _length(r["g"]) + _length(r["m"])
        totals = F.transform(cut, lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda s, r: s + spent(r)))
        starts = F.aggregate(
            totals, F.array(F.lit(0).cast("long")), lambda s, n: F.array_append(s, F.element_at(s, -1) + n)
        )

        def walk(block: Column, at: Column) -> Column:
            begun = F.struct(at.alias("at"), empty.alias("out"))

            def step(s: Column, r: Column) -> Column:
                start = s["at"] + _length(r["g"])
                end = start + _length(r["m"])
                hit = F.struct(start.alias("start"), F.lit(order).alias("ord"), F.lit(kind).alias("kind"), end.alias("end"),
                               r["b"].alias("word"))
                kept = F.when(_length(r["b"]) >= least, F.array_append(s["out"], hit)).otherwise(s["out"])
                return F.struct(end.alias("at"), kept.alias("out"))

            return F.aggregate(block, begun, step, lambda s: s["out"])

        return F.flatten(F.zip_with(cut, F.slice(starts, F.lit(1), F.size(cut)), walk))

    return F.when(F.size(whole) > 0, with_positions(whole, parts, gaps)).otherwise(empty)


def top_entropy(word: Column, letters: str, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits per character, of the windows of `word` over the alphabet `letters`.

    Counts move with the window: the character that enters adds to its count, the one that leaves takes from its own, and the sum of
    `n * log2(n)` changes by these two counts alone. Characters outside the alphabet count as one more letter.
    """
    folded = F.lower(word) if letters == letters.lower() else word
    points = F.transform(F.split(folded, ""), lambda c: F.instr(F.lit(letters), c))
    size = F.size(points)
    table = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 1)])
    weight = lambda n: F.element_at(table, n + 1)
    begun = F.struct(
        F.array_repeat(F.lit(0), len(letters) + 1).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")
    )

    def moved(counts: Column, letter: Column, by: int) -> Column:
        left, right = F.slice(counts, F.lit(1), letter), F.slice(counts, letter + 2, F.lit(len(letters) + 1))
        return F.concat(left, F.array(F.element_at(counts, letter + 1) + by), right)

    def step(s: Column, i: Column) -> Column:
        enters = F.element_at(points, i)
        old = F.element_at(s["counts"], enters + 1)
        leaves = F.when(i > window, F.element_at(points, F.greatest(i - window, F.lit(1))))
        # the character that leaves goes first, so no count ever exceeds the window
        held = F.when(leaves.isNull(), s["counts"]).otherwise(moved(s["counts"], F.coalesce(leaves, F.lit(0)), -1))
        was = F.element_at(s["counts"], F.coalesce(leaves, F.lit(0)) + 1)
        less = F.when(leaves.isNull(), 0.0).otherwise(weight(F.greatest(was - 1, F.lit(0))) - weight(was))
        old = F.element_at(held, enters + 1)
        total = s["sum"] + less + weight(old + 1) - weight(old)
        entropy = F.lit(math.log2(window)) - total / window
        best = F.when(i >= window, F.greatest(s["best"], entropy)).otherwise(s["best"])
        return F.struct(moved(held, enters, 1).alias("counts"), total.alias("sum"), best.alias("best"))

    return F.aggregate(F.sequence(F.lit(1), size), begun, step, lambda s: s["best"])


def _secret(word: Column, kind: str, letters: str, least_bits: float) -> Column:
    """Whether a window of the candidate that overlaps no allowed word reaches the threshold."""
    parts = F.split(word, ALLOWED, -1)
    if kind == "ebase":
        path = F.size(F.split(word, PATH, -1)) > PATH_MARKS
        parts = F.when(path, F.flatten(F.transform(parts, lambda p: F.split(p, PATH, -1)))).otherwise(parts)
    parts = F.filter(parts, lambda p: F.length(p) >= WINDOW)
    # short pieces that share all but one character of a window, so a long candidate takes time in proportion to its length
    step = SPAN - WINDOW + 1
    parts = F.flatten(
        F.transform(parts, lambda p: F.transform(F.sequence(F.lit(1), F.length(p), F.lit(step)), lambda i: p.substr(i, F.lit(SPAN))))
    )

    def random(p: Column) -> Column:
        high = top_entropy(p, letters) >= least_bits
        if kind != "ebase":
            return high
        return (F.regexp_count(p, F.lit(SMALL)) <= SMALL_PART * (F.length(p) - 1)) & high

    fine = ~word.rlike(SHAPES) & F.exists(parts, random)
    if kind in ("elower", "eupper"):
        fine = fine & (~word.rlike("[+/_-]") | (F.size(F.regexp_extract_all(word, F.lit(TOUCH), F.lit(0))) >= TOUCHES))
    return fine


def secret_spans(text: Column) -> Column:
    """Array of `(start, ord, kind, end, word)` of everything found in `text`, by start, then kind; null counts as empty.

    Base kinds are `assign`, `access` and `hex`. The entropy scan adds `ehex`, `ebase`, `elower` and `eupper`: candidate strings of one character class, at
    least a window long and set off from other such characters, in which some window's entropy reaches the
    class's threshold. `ebase` holds letters of both cases, with or without digits; names in which small letters follow one another
    are none, and the parts of a path are judged by themselves. `elower` and `eupper` hold digits and letters of one case. Windows that overlap a word of the allow-list do not
    count, and candidates of an allowed shape are suppressed; base spans never are.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    found = [_found(text, p, k, b, LEAST[k]) for p, k, b in ((ASSIGN, "assign", 2), (ACCESS, "access", 0), (HEX, "hex", 0))]
    for kind, (pattern, letters, least_bits) in CLASSES.items():
        candidates = _found(text, pattern, kind, 0, WINDOW)
        found.append(F.filter(candidates, lambda r: _secret(r["word"], kind, letters, least_bits)))
    return F.array_sort(F.concat(*found))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """`(doc_id, spans)` for every row of `docs`: what `secret_spans` finds in the whole text."""
    return docs.select("doc_id", secret_spans(F.col("text")).alias("spans"))


def span_list(spans: Column) -> Column:
    """`kind:start:end`, joined by commas."""
    one = lambda r: F.concat_ws(":", r["kind"], r["start"].cast("string"), r["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
