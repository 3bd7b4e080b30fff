"""Personal data in whole texts: candidate spans, boosted trees over their format and context, calibrated thresholds.

Generators propose spans of four kinds. The plain ones (``BASE``) are checked (octets, Luhn, number of digits); what
passes is personal data whatever the trees say. The wide ones (``WIDE``) look between the plain matches
of their kind for other spellings: (at) and (dot), [.] between octets, other separators in
card numbers, phone numbers without a country code. Proposals of different kinds may overlap.

Each candidate has a few small features of its format and of the characters beside it (see ``FEATURES``). The weak labels
come from evidence that no feature holds: a plain match is positive if it passes its check, a wide one if it passes and a
word before it names its kind. So the trees learn which formats go with that evidence, and find the ones without a naming word too.
Candidates of all documents are counted by feature vector and label (there are at most a few thousand
vectors, whatever the corpus), and gradient-boosted trees of depth two are fitted to the counts of
even documents. For each kind, the threshold is the lowest score from which on at least ``PRECISION`` of the
wide candidates in odd documents are positive. Wide candidates that pass their check and reach it are added.

Everything that touches rows is a DataFrame expression; the driver only sees the counted vectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapecheck.llm.tables import stored

KINDS = ("email", "ip", "card", "phone")
TREES, RATE, LEAST, PRECISION = 40, 0.3, 5.0, 0.95

# Possessive quantifiers and the look-behind change nothing about what is found; they keep the search
# linear and free of recursion on long runs. A match may begin at the end of the one before it (\G).
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of this has no span of the kind.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
WIDE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{1,2}[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+(])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20./-])[0-9]{3,4}[\x20./-][0-9]{3,4}(?![0-9])",
}
WIDE_HINT = {"email": r"[\[(]at[\])]", "ip": r"\[\.\][0-9]", "card": r"[0-9]{4}[\x20._/-]{1,2}[0-9]{4}[\x20._/-]", "phone": r"[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20./-][0-9]{3,4}"}
#: Words that name a kind, looked for in the ``NEAR`` characters before a span.
NAMED = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|address)",
    "ip": r"(?i)\b(?:ip|host|server|address|login)",
    "card": r"(?i)\b(?:card|visa|master|amex|credit|payment|iban)",
    "phone": r"(?i)\b(?:tel|phone|call|fax|mobile|cell|whatsapp)",
}
NEAR = 24
FEATURES = ("spelling", "digits", "groups", "separator", "before", "after", "long")


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), fn), 0)


def _running(lengths: Column) -> Column:
    """Sums of all elements before each element, in two levels so that long arrays stay cheap."""
    width = 256

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0).cast("bigint"), lambda x, y: x + y)

    blocks = F.sequence(F.lit(0), F.floor((F.greatest(F.size(lengths), F.lit(1)) - 1) / width).cast("int"))
    sums = F.transform(blocks, lambda b: total(F.slice(lengths, b * width + 1, F.lit(width))))
    return let(
        sums,
        lambda s: let(
            F.transform(s, lambda _, b: total(F.slice(s, F.lit(1), b))),
            lambda low: F.transform(
                lengths,
                lambda _, i: F.get(low, F.floor(i / width).cast("int"))
                + total(F.slice(lengths, F.floor(i / width).cast("int") * width + 1, i % width)),
            ),
        ),
    )


def found(text: Column, pattern: str, offset: Column) -> Column:
    """Array of (start, end, value, left, right) of the matches in ``text``, and of (at, text) of what is between them."""
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("gaps"))

    def placed(x: Column) -> Column:
        lengths = F.zip_with(x["gaps"], x["m"], lambda g, v: (F.length(g) + F.coalesce(F.length(v), F.lit(0))).cast("bigint"))
        return let(
            _running(lengths),
            lambda at: F.struct(
                F.transform(
                    x["m"],
                    lambda v, i: F.struct(
                        (offset + F.get(at, i) + F.length(F.get(x["gaps"], i))).alias("start"),
                        (offset + F.get(at, i) + F.length(F.get(x["gaps"], i)) + F.length(v)).alias("end"),
                        v.alias("value"),
                        F.substring(F.get(x["gaps"], i), -NEAR, NEAR).alias("left"),
                        F.substring(F.get(x["gaps"], i + 1), 1, 1).alias("right"),
                    ),
                ).alias("spans"),
                F.transform(x["gaps"], lambda g, i: F.struct((offset + F.get(at, i)).alias("at"), g.alias("text"))).alias("gaps"),
            ),
        )

    return let(both, placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    def double(x: Column) -> Column:
        return F.when(x > 4, 2 * x - 9).otherwise(2 * x)

    def holds(d: Column) -> Column:
        digit = lambda i: F.substring(d, -i, F.lit(1)).cast("int")
        total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda s, i: s + F.when(i % 2 == 0, double(digit(i))).otherwise(digit(i)))
        return F.when(F.length(d).between(13, 19), total % 10 == 0).otherwise(F.lit(False))

    return let(_digits(value), holds)


def octets(value: Column) -> Column:
    def small(p: Column) -> Column:
        return F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255).otherwise(F.lit(False))

    return F.forall(F.split(F.regexp_replace(value, r"[\[\]]", ""), r"\."), small)


CHECK: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": octets,
    "card": luhn,
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def _side(c: Column) -> Column:
    """0 nothing or a line's end, 1 white space, 2 a letter or digit, 3 anything else."""
    return F.when((c == "") | (c == "\n"), 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[\p{L}\p{N}]"), 2).otherwise(3)


def _candidate(kind: str, wide: bool, s: Column) -> Column:
    """(kind, start, end, wide, passes, positive, features...) of a span."""
    check = CHECK[kind](s["value"])
    separator = (
        F.when(s["value"].contains("("), 4).when(s["value"].rlike("[_/]"), 5).when(s["value"].contains(" "), 1)
        .when(s["value"].contains("-"), 2).when(s["value"].contains("."), 3).otherwise(0)
    )
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        s["start"].alias("start"),
        s["end"].alias("end"),
        F.lit(wide).alias("wide"),
        check.alias("passes"),
        (check & s["left"].rlike(NAMED[kind]) if wide else check).alias("positive"),
        F.lit(int(wide)).alias("spelling"),
        F.least(F.length(_digits(s["value"])), F.lit(20)).cast("int").alias("digits"),
        F.least(F.size(F.regexp_extract_all(s["value"], F.lit("[0-9]++"), F.lit(0))), F.lit(9)).alias("groups"),
        separator.alias("separator"),
        _side(F.substring(s["left"], -1, 1)).alias("before"),
        _side(s["right"]).alias("after"),
        (F.length(s["value"]) > 24).cast("int").alias("long"),
    )


def _taken(kind: str, wide: bool) -> Callable[[Column], Column]:
    return lambda s: _candidate(kind, wide, s)


def _between(kind: str) -> Callable[[Column], Column]:
    return lambda gap: found(gap["text"], WIDE[kind], gap["at"])["spans"]


CANDIDATE = "array<struct<kind:int,start:bigint,end:bigint,wide:boolean,passes:boolean,positive:boolean," + ",".join(f"{f}:int" for f in FEATURES) + ">>"


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, fold, found): the candidates of each whole text."""
    text = F.col("text")
    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    columns = []
    for kind in KINDS:
        hint = text.contains(HINT[kind]) if kind == "email" else text.rlike(HINT[kind])
        plain = F.when(hint, found(text, BASE[kind], F.lit(0).cast("bigint")))
        out = out.withColumn(f"_{kind}", plain)
        spans = F.when(F.col(f"_{kind}").isNotNull(), F.transform(F.col(f"_{kind}.spans"), _taken(kind, False)).cast(CANDIDATE))
        gaps = F.coalesce(F.col(f"_{kind}.gaps"), F.array(F.struct(F.lit(0).cast("bigint").alias("at"), text.alias("text"))))
        more = F.flatten(F.transform(gaps, _between(kind)))
        more = F.when(text.rlike(WIDE_HINT[kind]), F.transform(more, _taken(kind, True)).cast(CANDIDATE))
        columns += [F.coalesce(c, F.array().cast(CANDIDATE)) for c in (spans, more)]
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2, F.lit(0)).cast("int")
    return out.select("doc_id", fold.alias("fold"), F.concat(*columns).alias("found"))


class Trees:
    """Gradient-boosted trees of depth two over small integer features, fitted to counted vectors."""

    def __init__(self, rows: list[tuple[tuple[int, ...], float, float]]):
        """rows: (kind and features, positives, negatives)."""
        self.trees: list[tuple] = []
        p, n = sum(r[1] for r in rows), sum(r[2] for r in rows)
        self.start = math.log((p + 1) / (n + 1))
        score = [self.start] * len(rows)
        for _ in range(TREES if p and n else 0):
            g, h = [], []
            for (_, a, b), s in zip(rows, score, strict=True):
                q = 1 / (1 + math.exp(-s))
                g.append(a - (a + b) * q)
                h.append((a + b) * q * (1 - q))
            tree = self._split(rows, g, h, list(range(len(rows))), 2)
            self.trees.append(tree)
            score = [s + self._leaf(tree, r[0]) for s, r in zip(score, rows, strict=True)]

    def _split(self, rows: list, g: list[float], h: list[float], own: list[int], depth: int) -> tuple:
        gs, hs = sum(g[k] for k in own), sum(h[k] for k in own)
        best = (1e-6, None, None)
        for f in range(len(FEATURES) + 1) if depth else ():
            by: dict[int, list[float]] = {}
            for k in own:
                v = by.setdefault(rows[k][0][f], [0.0, 0.0])
                v[0] += g[k]
                v[1] += h[k]
            gl = hl = 0.0
            for value in sorted(by)[:-1]:
                gl, hl = gl + by[value][0], hl + by[value][1]
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                if gain > best[0]:
                    best = (gain, f, value)
        if best[1] is None:
            return (RATE * gs / (hs + 1),)
        left = [k for k in own if rows[k][0][best[1]] <= best[2]]
        right = [k for k in own if rows[k][0][best[1]] > best[2]]
        return (best[1], best[2], self._split(rows, g, h, left, depth - 1), self._split(rows, g, h, right, depth - 1))

    def _leaf(self, tree: tuple, x: tuple[int, ...]) -> float:
        while len(tree) > 1:
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree[0]

    def score(self, x: tuple[int, ...]) -> float:
        return self.start + sum(self._leaf(t, x) for t in self.trees)

    def column(self, c: Column) -> Column:
        """The score of a candidate as an expression."""

        def of(tree: tuple) -> Column:
            if len(tree) == 1:
                return F.lit(tree[0])
            feature = "kind" if tree[0] == 0 else FEATURES[tree[0] - 1]
            return F.when(c[feature] <= tree[1], of(tree[2])).otherwise(of(tree[3]))

        return sum(map(of, self.trees), F.lit(self.start))


def fitted(table: DataFrame) -> tuple[Trees, list[float]]:
    """The trees from the candidates of even documents, and each kind's threshold from the wide ones of odd documents."""
    names = ["kind", *FEATURES]
    counts = table.select("fold", F.explode("found").alias("c")).groupBy("fold", *(F.col(f"c.{n}").alias(n) for n in names))
    counts = counts.agg(F.sum(F.col("c.positive").cast("int")).alias("p"), F.count("*").alias("n")).orderBy("fold", *names).collect()
    rows = {f: [(tuple(r[n] for n in names), float(r.p), float(r.n - r.p)) for r in counts if r.fold == f] for f in (0, 1)}
    trees = Trees(rows[0])
    cuts = []
    for kind in range(len(KINDS)):
        cut, p, n = math.inf, 0.0, 0.0
        for s, a, b in sorted(((trees.score(x), a, b) for x, a, b in rows[1] if x[0] == kind and x[1 + FEATURES.index("spelling")]), reverse=True):
            p, n = p + a, n + b
            if p + n >= LEAST and p >= PRECISION * (p + n):
                cut = s
        cuts.append(cut)
    return trees, cuts


def _text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: counts and hash of the plain spans, and all spans as text and as an array.

    ``n_added`` counts the spans that the trees add, ``n_spans`` all spans of the text, of whatever kind.
    A null text counts as empty; its row has no spans. Rows that repeat a doc_id have a row each.
    """
    table = stored(candidates(docs), "candidates")
    trees, cuts = fitted(table)
    cut = F.array(*(F.lit(c) for c in cuts))
    place = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    plain = F.transform(F.filter("found", lambda c: ~c["wide"] & c["positive"]), place)
    more = F.transform(F.filter("found", lambda c: c["wide"] & c["passes"] & (trees.column(c) >= F.get(cut, c["kind"]) - 1e-9)), place)
    out = table.select("doc_id", plain.alias("plain"), more.alias("more"))
    count = lambda k: F.size(F.filter("plain", lambda s: s["kind"] == k)).cast("bigint")
    return out.select(
        "doc_id",
        *(count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)),
        F.sha2(_text(F.col("plain")), 256).alias("base_sha256"),
        _text(F.concat("plain", "more")).alias("spans"),
        F.size("more").cast("bigint").alias("n_added"),
        (F.size("plain") + F.size("more")).cast("bigint").alias("n_spans"),
    )
