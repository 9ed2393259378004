"""Personal data: generators propose spans, boosted trees judge them, calibrated thresholds select.

Four kinds of base span follow fixed rules and always stay. Looser generators propose
more spans (written-out e-mail addresses, numbers without a country code, card
numbers that fail their checksum or are too short, addresses with other separators), which
overlap each other and the base spans. Gradient-boosted trees judge a proposal by
its format and the words before it. Their target is not given away by what makes a base span:
examples are base spans of the documents rewritten into the forms the generators look for, where they
stand; counter-examples are random runs of digits or words in the same forms at random places. Both
must be proposed by the generator of their kind. A few thousand made-up texts are learned from as well, so
a kind without a base span has examples too. The threshold of a kind is the lowest score that
at most ``1 - PRECISION`` of the counter-examples reach that the trees did not learn from, whatever the number of
base spans; proposals that reach it and overlap no stronger span are added.

Only DataFrame expressions touch the texts, inside one row: no shuffle, no Python.
The trees see a few small discrete features, so the documents are reduced to a count for each
combination of values (a bounded table) before the trees are grown on the driver;
the grown trees are one expression over a constant array.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.once import computed

KINDS = ("email", "ip", "card", "phone")

# Base rules in a form that matches the same text without backtracking or rescans: possessive
# repeats where what follows cannot begin inside them, and starts only where a longer match could not.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a rule to be tried.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
OCTET = r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})$"

# Looser generators. Bounded repeats keep them linear.
LOOSE = {
    "email": r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64}(?:\x20?[\[({<]\x20?(?:at|@)\x20?[\])}>]\x20?|\x20at\x20|\x20@\x20)"
             r"[A-Z0-9-]{1,63}(?:(?:\x20?[\[({<]\x20?(?:dot|\.)\x20?[\])}>]\x20?|\x20dot\x20|\.)[A-Z0-9-]{1,63}){1,6}",
    "ip": r"(?<![0-9.:,_-])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|,|_|-)[0-9]{1,3}){3}(?![0-9.,_-])",
    "card": r"(?<![0-9A-Za-z.+-])[0-9](?:[\x20.-]?[0-9]){12,18}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.+-])(?:00[1-9]|\([0-9]{2,5}\)|0[0-9]|[0-9]{3}[\x20.-])[\x20.-]?[0-9]{2,5}(?:[\x20./-]?[0-9]{2,5}){1,4}(?![0-9A-Za-z])",
}
HINTS = {"email": r"(?i)[\x20\[({<](?:at|@)[\x20\])}>]", "ip": r"[0-9](?:[\[(]\.[\])]|[,_-])[0-9]", "card": r"[0-9]", "phone": r"[0-9]"}
CONTEXT = 24
CUES = {
    "email": r"(?i)(?:e-?mail|mailto|contact|write|courriel|correo|schreib)",
    "ip": r"(?i)(?:\bip\b|host|server|addr|login|from)",
    "card": r"(?i)(?:card|visa|credit|carte|karte|tarjeta|pay|iban)",
    "phone": r"(?i)(?:phone|call|tel|mobil|fax|cell|whatsapp|ruf|appel|llam)",
}

ROUNDS, DEPTH, RATE = 40, 3, 0.3
PRECISION = 0.98       # share of the held-out counter-examples that stay below a threshold
MADE = 4096            # made-up texts that are learned from besides the documents
DOMAINS = r"(?i)[.\x20\])}>](?:com|org|net|edu|gov|info|biz|io|eu|uk|de|fr|es|it|nl|ch|at|pl|pt|br|jp|cn|in|ru|au|ca|us|vn|example)$"


# --- spans of one pattern ---------------------------------------------------------------------------------------------

def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` repeats it or puts it in a lambda."""
    return F.get(F.transform(F.array(value), use), 0)


def _sums(numbers: Column) -> Column:
    """Running sums, in blocks so that long arrays cost less than the square of their length."""
    block = 128
    zero = F.array().cast("array<long>")

    def run(part: Column) -> Column:
        return F.aggregate(part, zero, lambda acc, n: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + n)))

    def long(values: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))
        return _let(F.transform(starts, lambda b: run(F.slice(values, b * block + 1, block))), shifted)

    def shifted(blocks: Column) -> Column:
        tops = run(F.transform(blocks, lambda b: F.try_element_at(b, F.lit(-1))))
        before = F.concat(F.array(F.lit(0).cast("long")), tops)
        return F.flatten(F.zip_with(blocks, F.slice(before, 1, F.size(blocks)), lambda b, t: F.transform(b, lambda n: n + t)))

    return _let(numbers, lambda values: F.when(F.size(values) <= block, run(values)).otherwise(long(values)))


def _matches(text: Column, pattern: str, when: Column) -> Column:
    """All matches as array<struct<start, end, value>>, code points, end exclusive; none unless ``when``.

    The pieces between matches give their places; they are made only for texts
    with a match.
    """
    empty = F.array().cast("array<struct<start: long, end: long, value: string>>")

    def build(values: Column, pieces: Column) -> Column:
        steps = F.zip_with(values, F.slice(pieces, 1, F.size(values)), lambda v, p: (F.length(p) + F.length(v)).cast("long"))
        return F.zip_with(_sums(steps), values, lambda e, v: F.struct((e - F.length(v)).alias("start"), e.alias("end"), v.alias("value")))

    values = F.regexp_extract_all(F.when(when, text), F.lit(pattern), F.lit(0))
    return F.coalesce(_let(values, lambda v: F.when(F.size(v) > 0, _let(F.split(text, pattern, -1), lambda p: build(v, p)))), empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Checksum of a digit string, doubling every second digit from the right."""
    doubled = F.array(*[F.lit(2 * d - 9 * (d > 4)) for d in range(10)])

    def check(digits: Column) -> Column:
        at = F.split(F.reverse(digits), "")
        sums = F.zip_with(at, F.sequence(F.lit(0), F.size(at) - 1), lambda d, i: F.when(
            i % 2 == 0, d.cast("int")).otherwise(F.get(doubled, d.cast("int"))))
        return F.aggregate(sums, F.lit(0), lambda acc, n: acc + F.coalesce(n, F.lit(0))) % 10 == 0

    return _let(value, check)


def _passes(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike(OCTET))
    if kind == "card":
        return _let(_digits(value), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))
    return F.length(_digits(value)).between(8, 15)


def base_spans(text: Column) -> dict[str, Column]:
    """By kind: the spans of the base rule, failing matches dropped."""
    out = {}
    for kind in KINDS:
        need = NEEDS[kind]
        when = F.contains(text, F.lit(need)) if need else text.rlike("[0-9]")
        out[kind] = F.filter(_matches(text, BASE[kind], when), lambda m: _passes(kind, m["value"]))
    return out


# --- proposals and their features -------------------------------------------------------------------------------------

FEATURES = ("kind", "length", "digits", "groups", "separators", "checksum", "cue", "before", "after", "prefix")


def _features(kind: str, value: Column, before: Column, after: Column) -> list[Column]:
    """Small integers only; their number of combinations bounds what learning gathers."""
    digits = _digits(value)
    groups = F.size(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)))
    if kind == "card":
        checksum = F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    elif kind == "ip":
        checksum = F.forall(F.split(value, r"[^0-9]+"), lambda p: p.rlike(OCTET))
    else:
        # No checksum: a known end of an address, four digits at the end of a number.
        checksum = value.rlike(DOMAINS if kind == "email" else "[^0-9][0-9]{4}$")
    # How the value begins; of an address whether its local part is more than letters, of a card the usual groups.
    if kind == "email":
        prefix = value.rlike(r"^[A-Za-z]*[0-9._%+-]").cast("int")
    elif kind == "card":
        prefix = F.when(value.rlike(r"^[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$"), 1).when(
            value.rlike(r"^[0-9]{4}[\x20.-][0-9]{6}[\x20.-][0-9]{5}$"), 2).otherwise(0)
    else:
        prefix = F.when(value.rlike(r"^\+"), 3).when(value.rlike("^00"), 2).when(value.rlike(r"^\("), 1).otherwise(0)
    return [
        F.lit(KINDS.index(kind)),
        F.least(F.floor(F.length(value) / 6), F.lit(6)),
        F.least(F.floor(F.length(digits) / 2), F.lit(10)),
        F.least(groups, F.lit(5)),
        F.when(value.rlike("[\\[({<]"), 3).when(value.rlike(r"\x20"), 2).when(value.rlike("[-./,_]"), 1).otherwise(0),
        checksum.cast("int"),
        F.greatest(*[F.when(before.rlike(CUES[k]), KINDS.index(k) + 1).otherwise(0) for k in KINDS]),
        F.when(F.trim(before) == "", 0).when(before.rlike(r"[:=#]\x20?$"), 1).when(before.rlike(r"\s$"), 2).otherwise(3),
        F.when(F.trim(after) == "", 0).when(after.rlike(r"^[\s.,;:!?)]"), 1).otherwise(2),
        prefix,
    ]


def _with_base(docs: DataFrame, text: str) -> DataFrame:
    """Add ``_text`` (null as empty), the base spans as ``_base_<kind>`` and the places they take as ``_taken``.

    Each step is computed once and then only referred to, as what stands inside a
    lambda is otherwise computed for every element.
    """
    docs = computed(docs, _text=F.coalesce(F.col(text), F.lit("")))
    docs = computed(docs, **{f"_base_{kind}": spans for kind, spans in base_spans(F.col("_text")).items()})
    return computed(docs, _taken=F.flatten(F.array(*[F.transform(f"_base_{k}", lambda m: F.struct(m["start"], m["end"])) for k in KINDS])))


def _with_proposals(docs: DataFrame) -> DataFrame:
    """Add ``_proposed``, an array of (kind, start, end, features): what the loose generators find outside the base spans."""
    text = F.col("_text")
    docs = computed(docs, **{f"_loose_{kind}": F.filter(_matches(text, LOOSE[kind], text.rlike(HINTS[kind])), lambda m: ~F.exists(
        "_taken", lambda t: (t["start"] < m["end"]) & (m["start"] < t["end"]))) for kind in KINDS})
    out = [F.transform(f"_loose_{kind}", lambda m: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
        _numbers(kind, m["value"], _before(text, m["start"]), F.substring(text, m["end"] + 1, F.lit(2))).alias("features"))) for kind in KINDS]
    return computed(docs, _proposed=F.flatten(F.array(*out)))


def _before(text: Column, at: Column) -> Column:
    return F.substring(text, F.greatest(at - CONTEXT, F.lit(0)) + 1, F.least(at, F.lit(CONTEXT)))


def _numbers(kind: str, value: Column, before: Column, after: Column) -> Column:
    return F.array(*[c.cast("int") for c in _features(kind, value, before, after)])


# --- examples and counter-examples ------------------------------------------------------------------------------------

def _draw(n: int, *seed) -> Column:
    """A number from 0 to n - 1 by hash."""
    return F.pmod(F.xxhash64(*[s if isinstance(s, Column) else F.lit(s) for s in seed]), F.lit(n)).cast("int")


def _one_of(at: Column, values) -> Column:
    return F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), at)


def _cut(digits: Column, separator: Column, *sizes) -> Column:
    """Runs of digits of these sizes with the separator between them; empty ones are left out."""
    parts, at = [], F.lit(1)
    for size in sizes:
        size = size if isinstance(size, Column) else F.lit(size)
        parts.append(F.substring(digits, at, size))
        at = at + size
    return F.replace(F.array_join(F.filter(F.array(*parts), lambda p: p != ""), "~"), F.lit("~"), separator)


def _checked(digits: Column) -> Column:
    """The digits and one more that makes the checksum hold."""
    ends = F.array(*[F.lit(str(d)) for d in range(10)])
    return _let(digits, lambda known: F.concat(known, F.get(F.filter(ends, lambda d: _luhn(F.concat(known, d))), 0)))


def _rewritten(kind: str, value: Column, h: Column) -> Column:
    """A base span in a form the base rule does not match; ``h`` chooses the form."""
    if kind == "email":
        dot = _one_of(_draw(3, h, 1), (" dot ", "[dot]", "."))
        at = _one_of(_draw(4, h, 2), (" at ", " [at] ", "(at)", " @ "))
        return F.concat(F.substring_index(value, "@", 1), at, F.replace(F.substring_index(value, "@", -1), F.lit("."), dot))
    if kind == "ip":
        return F.replace(value, F.lit("."), _one_of(_draw(5, h, 1), ("[.]", "(.)", ",", "_", "-")))
    if kind == "card":
        digits = _digits(value)
        wrong = F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), ((F.substring(digits, -1, 1).cast("int") + 1) % 10).cast("string"))
        short = _checked(F.substring(digits, 1, 14))
        return _one_of(_draw(5, h, 1), (
            _cut(digits, F.lit("."), 4, 4, 4, 7), wrong, _cut(wrong, F.lit(" "), 4, 4, 4, 7), short, _cut(short, F.lit(" "), 4, 6, 5)))
    national = F.regexp_replace(value, r"^\+[0-9]{1,3}[ .-]*", "")
    plain = F.regexp_replace(F.regexp_replace(national, r"[^0-9]+", " "), r"^ ", "")
    return _one_of(_draw(5, h, 1), (
        national, F.replace(plain, F.lit(" "), F.lit("-")), F.replace(plain, F.lit(" "), F.lit(".")),
        F.concat(F.lit("0"), plain), F.concat(F.lit("00"), F.regexp_replace(F.substring(value, 2, 40), r"[^0-9]+", " "))))


def _random(kind: str, h: Column, digits: Column, near: Column) -> Column:
    """A run of random digits, or of words ``near`` a place, in a form the generator of the kind looks for."""
    if kind == "email":
        words = F.concat(F.get(near, 1), _one_of(_draw(2, h, 21), (" at ", " @ ")), F.get(near, 2), F.lit("."), F.get(near, 3))
        price = F.concat(_cut(digits, F.lit(""), _draw(3, h, 22) + 1), F.lit(" @ "), _cut(digits, F.lit("."), _draw(3, h, 23) + 1, 2))
        return F.when((_draw(4, h, 24) > 0) & (F.size(near) > 3), words).otherwise(price)
    if kind == "ip":
        return _cut(digits, _one_of(_draw(3, h, 31), (",", "-", "_")), *[_draw(3, h, 32 + i) + 1 for i in range(4)])
    if kind == "card":
        run = F.substring(digits, F.lit(1), _draw(7, h, 41) + 13)
        return F.when(_draw(2, h, 42) == 0, run).otherwise(
            _cut(run, _one_of(_draw(3, h, 43), (" ", "-", ".")), *[_draw(5, h, 44 + i) + 2 for i in range(3)], 19))
    sizes = [_draw(4, h, 52) + 2, _draw(4, h, 53) + 2, *[F.when(_draw(2, h, 54 + i) == 0, 0).otherwise(_draw(4, h, 57 + i) + 2) for i in range(3)]]
    groups = _cut(F.substring(digits, 4, 40), _one_of(_draw(4, h, 51), (" ", "-", ".", "/")), *sizes)
    return _one_of(_draw(5, h, 50), (
        *[F.concat(F.lit("0"), F.substring(digits, F.lit(1), _draw(15, h, 60) + 5))] * 2,
        *[F.concat(F.substring(digits, 1, 3), _one_of(_draw(3, h, 61), (" ", "-", ".")), groups)] * 2,
        F.concat(F.lit("("), F.substring(digits, F.lit(1), _draw(2, h, 62) + 2), F.lit(") "), groups)))


def _with_examples(docs: DataFrame) -> DataFrame:
    """Add ``_examples``, an array of (features, example): the base spans rewritten, where they stand, and a
    counter-example of each kind at a random place outside the base spans."""
    text = F.col("_text")
    docs = computed(docs, _h=F.xxhash64(text))
    docs = computed(docs, _place=_draw(1 << 30, F.col("_h"), 70) % F.greatest(F.length(text), F.lit(1)),
                    _run=F.regexp_replace(F.sha2(F.col("_h").cast("string"), 512), "[^0-9]", ""))
    docs = computed(docs, _front=F.regexp_replace(_before(text, F.col("_place")), r"\S*$", ""), _behind=F.substring(text, F.col("_place") + 1, F.lit(160)))
    docs = computed(docs, _near=F.regexp_extract_all("_behind", F.lit("[A-Za-z0-9-]+"), F.lit(0)),
                    _back=F.regexp_extract("_behind", r"(?s)^[^\s.,;:!?)]*(.{0,2})", 1))
    free = ~F.exists("_taken", lambda t: (t["start"] <= F.col("_place")) & (F.col("_place") <= t["end"]))
    out = []
    for kind in KINDS:
        docs = computed(docs, **{f"_random_{kind}": F.when(free, _random(kind, F.col("_h"), F.col("_run"), F.col("_near")))})
        docs = computed(docs, **{f"_seen_{kind}": F.concat(
            F.transform(f"_base_{kind}", lambda m: F.struct(
                _rewritten(kind, m["value"], F.xxhash64(m["value"], m["start"])).alias("value"), _before(text, m["start"]).alias("before"),
                F.substring(text, m["end"] + 1, F.lit(2)).alias("after"), F.lit(True).alias("example"))),
            F.array(F.struct(F.col(f"_random_{kind}").alias("value"), F.col("_front").alias("before"), F.col("_back").alias("after"),
                             F.lit(False).alias("example"))))})
        proposed = F.filter(f"_seen_{kind}", lambda s: s["value"].rlike(f"^(?:{LOOSE[kind]})$"))
        out.append(F.transform(proposed, lambda s: F.struct(_numbers(kind, s["value"], s["before"], s["after"]).alias("features"), s["example"].alias("example"))))
    return computed(docs, _examples=F.flatten(F.array(*out)))


def _made(spark: SparkSession) -> DataFrame:
    """``MADE`` texts ``_given`` with a base span of each kind in turn, half of them behind a word that announces it."""
    common = ("the", "of", "and", "for", "with", "page", "list", "number", "order", "report", "meeting", "house", "garden", "water", "year", "people")
    h = F.xxhash64("id", F.lit(80))
    word = lambda n: _one_of(_draw(len(common), h, n), common)
    digits = F.regexp_replace(F.sha2(h.cast("string"), 512), "[^0-9]", "")
    code = _one_of(_draw(4, h, 81), ("1", "44", "49", "84"))
    value = {
        "email": F.concat(word(82), _one_of(_draw(4, h, 83), (".", "_", "", "")), word(84), _one_of(_draw(2, h, 85), ("", F.substring(digits, 1, 2))),
                          F.lit("@"), word(86), F.lit("."), _one_of(_draw(4, h, 87), ("com", "org", "net", "de"))),
        "ip": F.concat_ws(".", *[_draw(256, h, 88 + i).cast("string") for i in range(4)]),
        "card": _cut(_checked(F.concat(_one_of(_draw(4, h, 93), ("3", "4", "5", "6")), F.substring(digits, 1, 14))),
                     _one_of(_draw(3, h, 94), ("", " ", "-")), 4, 4, 4, 4),
        "phone": F.concat(F.lit("+"), code, _one_of(_draw(3, h, 95), (
            F.concat(F.lit(" ("), F.substring(digits, 1, 3), F.lit(") "), _cut(F.substring(digits, 4, 7), F.lit("-"), 3, 4)),
            F.concat(F.lit(" "), _cut(digits, F.lit(" "), 2, 4, 4)), F.concat(F.lit("-"), _cut(digits, F.lit("-"), 3, 3, 4))))),
    }
    cue = {"email": "email", "ip": "server", "card": "card:", "phone": "call"}
    kind = F.pmod("id", F.lit(len(KINDS))).cast("int")
    announced = F.when(_draw(2, h, 96) == 0, _one_of(kind, [cue[k] for k in KINDS])).otherwise(word(97))
    return spark.range(0, MADE, 1, 2).select(F.concat_ws(
        " ", *[word(100 + i) for i in range(8)], announced, _one_of(kind, [value[k] for k in KINDS]), *[word(110 + i) for i in range(8)]).alias("_given"))


# --- boosted trees over the table of feature combinations ---------------------------------------------------------------

@dataclass(frozen=True)
class Trees:
    """Trees as nested (feature, bound, low, high) tuples with numbers as leaves; thresholds by kind."""

    bias: float
    trees: list = field(default_factory=list)
    thresholds: tuple[float, ...] = (math.inf,) * len(KINDS)

    def score(self, cell) -> float:
        """Added up in the order of :meth:`column`, so both are equal to the last bit."""
        total = self.bias
        for tree in self.trees:
            total += _leaf(tree, cell)
        return total

    def column(self, features: Column) -> Column:
        """The score as an expression over the array of features: all trees are one constant
        array of complete trees, which a fold walks through."""
        forest = F.expr("array(" + ", ".join(_literal(tree) for tree in self.trees) + ")")

        def down(tree: Column, at: Column) -> Column:
            return F.when(F.get(features, F.get(tree["f"], at)) <= F.get(tree["b"], at), 2 * at + 1).otherwise(2 * at + 2)

        def walk(tree: Column, at: Column, depth: int) -> Column:
            if not depth:
                return F.get(tree["v"], at - ((1 << DEPTH) - 1))
            return _let(down(tree, at), lambda below: walk(tree, below, depth - 1))

        return F.aggregate(forest, F.lit(self.bias), lambda acc, tree: acc + walk(tree, F.lit(0), DEPTH))


def _leaf(tree, cell) -> float:
    while isinstance(tree, tuple):
        feature, bound, low, high = tree
        tree = low if cell[feature] <= bound else high
    return tree


def _literal(tree) -> str:
    """SQL of a tree filled up to ``DEPTH``: features and bounds of its forks, row by row, and its leaf values."""
    row, forks = [tree], []
    for _ in range(DEPTH):
        forks += [(t[0], t[1]) if isinstance(t, tuple) else (0, 0) for t in row]
        row = [child for t in row for child in ((t[2], t[3]) if isinstance(t, tuple) else (t, t))]
    return (f"named_struct('f', array({', '.join(str(f) for f, _ in forks)}), 'b', array({', '.join(str(b) for _, b in forks)}), "
            f"'v', array({', '.join(f'{v!r}D' for v in row)}))")


def _grow(cells, gradient, bend, rows, depth):
    """A regression tree on second-order gradients; ``rows`` index the cells."""
    g, h = sum(gradient[i] for i in rows), sum(bend[i] for i in rows)
    best = (1e-6, None)
    for feature in range(len(FEATURES)) if depth else ():
        by: dict[int, list[float]] = {}
        for i in rows:
            pair = by.setdefault(cells[i][feature], [0.0, 0.0])
            pair[0] += gradient[i]
            pair[1] += bend[i]
        left_g = left_h = 0.0
        for value in sorted(by)[:-1]:
            left_g, left_h = left_g + by[value][0], left_h + by[value][1]
            gain = left_g ** 2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g ** 2 / (h + 1)
            if gain > best[0] + 1e-9:
                best = (gain, (feature, value))
    if best[1] is None:
        return -RATE * g / (h + 1)
    feature, value = best[1]
    low = [i for i in rows if cells[i][feature] <= value]
    high = [i for i in rows if cells[i][feature] > value]
    return feature, value, _grow(cells, gradient, bend, low, depth - 1), _grow(cells, gradient, bend, high, depth - 1)


def boost(table: list[tuple[tuple[int, ...], float, float]], held: dict[tuple[int, ...], float] | None = None) -> Trees:
    """Trees from (features, examples, counter-examples) counts of each combination; ``held`` counts the
    counter-examples kept for the thresholds, else those of the table serve.

    Examples weigh as much as counter-examples in each kind. A kind without either adds nothing: its threshold is
    infinite.
    """
    cells = [c for c, _, _ in table]
    yes, no = [0.0] * len(KINDS), [0.0] * len(KINDS)
    for c, p, n in table:
        yes[c[0]], no[c[0]] = yes[c[0]] + p, no[c[0]] + n
    good, bad = [float(p) * (no[c[0]] / yes[c[0]] if p and no[c[0]] else 1.0) for c, p, _ in table], [float(n) for _, _, n in table]
    if not sum(good) or not sum(bad):
        return Trees(0.0)
    bias = math.log(sum(good) / sum(bad))
    scores, trees = [bias] * len(cells), []
    for _ in range(ROUNDS):
        p = [1 / (1 + math.exp(-max(-30.0, min(30.0, s)))) for s in scores]
        gradient = [(g + b) * q - g for q, g, b in zip(p, good, bad)]
        bend = [(g + b) * q * (1 - q) for q, g, b in zip(p, good, bad)]
        tree = _grow(cells, gradient, bend, range(len(cells)), DEPTH)
        trees.append(tree)
        scores = [s + _leaf(tree, c) for s, c in zip(scores, cells)]
    grown, held = Trees(bias, trees), {c: n for c, _, n in table} if held is None else held
    thresholds = []
    for kind in range(len(KINDS)):
        reached: dict[float, float] = {}  # counter-examples by score; combinations of one score pass together
        for c in {*cells, *held}:
            if c[0] == kind:
                score = grown.score(c)
                reached[score] = reached.get(score, 0.0) + held.get(c, 0.0)
        allowed, above, bound = (1 - PRECISION) * sum(reached.values()), 0.0, math.inf
        for score in sorted(reached, reverse=True) if yes[kind] and allowed else ():
            above += reached[score]
            if above > allowed:
                break
            bound = score
        thresholds.append(bound)
    return Trees(bias, trees, tuple(thresholds))


def fit(docs: DataFrame, text: str = "text") -> Trees:
    """Trees learned from all documents and the made-up texts.

    Counter-examples of every second text, by hash, are kept for the thresholds.
    One scan; map tasks add up the counts, so what is moved is bounded by the combinations of features.
    """
    texts = docs.select(F.col(text).alias("_given")).unionByName(_made(docs.sparkSession))
    found = _with_examples(_with_base(texts, "_given")).select(F.explode("_examples").alias("e"), (_draw(2, F.col("_h"), 71) == 1).alias("kept"))
    number = lambda rows: F.sum(rows.cast("long"))
    example = F.col("e.example")
    counted = found.groupBy(F.col("e.features").alias("features")).agg(
        number(example).alias("yes"), number(~example & ~F.col("kept")).alias("no"), number(~example & F.col("kept")).alias("held")).collect()
    return boost(sorted((tuple(r.features), r.yes, r.no) for r in counted if r.yes or r.no), {tuple(r.features): r.held for r in counted if r.held})


# --- the operator ---------------------------------------------------------------------------------------------------------

def with_spans(docs: DataFrame, trees: Trees, text: str = "text", into: str = "spans") -> DataFrame:
    """Add ``into``: array of (kind, start, end, base) of each text, by kind, then start.

    Null is an empty text. Base spans of different kinds may overlap, as the rules are
    independent; an added one overlaps no base span and no added one of a higher score. A column
    of ``docs`` named ``into`` is replaced; the others stay.
    """
    # Under names of their own, the given columns cannot clash with the steps'.
    own = {c: f"_own_{i}" for i, c in enumerate(docs.columns)}
    kept = [F.col(name).alias(c) for c, name in own.items() if c != into]
    rows = _with_base(docs.toDF(*own.values()), own[text])
    base = F.flatten(F.array(*[F.transform(f"_base_{k}", lambda m: F.struct(
        F.lit(KINDS.index(k)).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.lit(True).alias("base"))) for k in KINDS]))
    bounds = F.array(*[F.lit(min(t, 1e300)) for t in trees.thresholds])
    if all(t == math.inf for t in trees.thresholds):
        return computed(rows, _spans=F.array_sort(base)).select(*kept, F.col("_spans").alias(into))
    rows = _with_proposals(rows)
    rated = F.transform("_proposed", lambda p: F.struct((-trees.column(p["features"])).alias("low"), p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    rows = computed(rows, _above=F.array_sort(F.filter(rated, lambda p: -p["low"] >= F.get(bounds, p["kind"]))))
    # Strongest first; each is kept if it overlaps none kept before.
    empty = F.array().cast("array<struct<kind: int, start: long, end: long, base: boolean>>")
    added = F.aggregate("_above", empty, lambda acc, p: F.when(
        F.exists(acc, lambda t: (t["start"] < p["end"]) & (p["start"] < t["end"])), acc).otherwise(
        F.concat(acc, F.array(F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end"), F.lit(False).alias("base"))))))
    return computed(rows, _spans=F.array_sort(F.concat(base, added))).select(*kept, F.col("_spans").alias(into))


def joined(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redact(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; spans that overlap are one, named by the first."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["text"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))
        return F.struct(F.when(s["start"] >= acc["at"], fresh).otherwise(acc["text"]).alias("text"),
                        F.greatest(acc["at"], s["end"]).alias("at"))

    out = F.aggregate(ordered, start, step, lambda acc: F.concat(acc["text"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, out).otherwise(text)
