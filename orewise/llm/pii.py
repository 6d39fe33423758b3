"""Personal data: rules for the sure spans, gradient boosting for the doubtful ones.

High-recall patterns propose candidate spans of every kind, which may overlap. Boosted trees
score them by format and context; the trees are fitted with MLlib on planted examples and
then written out as column expressions, so that finding, scoring and redacting are one
projection of a document and nothing is shuffled. Thresholds are set for each kind on held-out
examples. Spans that the base rules find always stay; the trees add what those rules can't
see: addresses and numbers in disguise, numbers without a plus sign, keys and tokens.

Work is in proportion to a text's length, but for running sums over its matches, which are
made in blocks (their cost grows as the power 1.5 of the matches, a pointer each).
"""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

#: The base rules' kinds, and what only the trees find.
KINDS = ["email", "ip", "card", "phone", "secret"]
# The base patterns. Possessive repeats and look-behinds spare the engine from
# trying each character of a long run as a start; the matches stay the same.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NAME, _KEY = r"[^\s@|<>()\[\]{}\",;]", "[A-Za-z0-9_+/-]"
#: What proposes candidates: wider than the base patterns.
GENERATORS = {
    "email": rf"(?i)(?<!{_NAME}){_NAME}++(?:@|\x20?[\[({{]at[\])}}]\x20?){_NAME}++(?:\x20?[\[({{]dot[\])}}]\x20?{_NAME}++)*+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}+){3}(?!\.?[0-9])",
    "card": r"[0-9](?:[\x20./-]?[0-9])++",
    "phone": r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20()./-]{0,2}+[0-9])++",
    "secret": rf"(?<!{_KEY}){_KEY}{{16,}}+={{0,2}}",
}
CUES = {
    "cue_mail": "mail|contact|write|reach",
    "cue_ip": r"\bip\b|host|server|addr|ping|login",
    "cue_card": "card|visa|amex|mastercard|credit|paid|charge",
    "cue_phone": r"\btel|phone|\bcall|\bfax|mobile|\bcell\b|whatsapp|\bsms\b|\bdial|\bring\b",
    "cue_secret": r"token|secret|passw|api.?key|bearer|credential|private.?key|access.?key|auth",
    "cue_digest": r"commit|\bsha|md5|digest|checksum|etag|revision|uuid|trace|build|hash|file|blob",
    "cue_other": r"version|\bv$|order|invoice|isbn|issn|\bid\b|\bref|page|ticket|serial|section|https?:|\bno\b|total|sum|from|since|between|date|part|item",
}
FEATURES = [
    "kind", "n_chars", "n_digits", "n_letters", "n_marks", "n_dots", "n_upper", "plus", "paren", "at", "named", "hex", "luhn", "top_part", "groups", "longest",
    "word_before", "quote_before", "sign_before", "word_after", *CUES,
]
CONTEXT = 24
#: Planted examples that fit and calibrate the trees: a fixed number, whatever the corpus is.
EXAMPLES = 5_000
TREES, DEPTH, STEP = 12, 4, 0.4
#: Precision on held-out examples that a kind's threshold must reach; never below LEAST.
PRECISION, LEAST = 0.99, 0.8
#: Matches of a block in running sums.
BLOCK = 256


def _luhn_digit(digits: str) -> str:
    total = sum(int(c) * (1 + (k % 2 == 0)) - 9 * (k % 2 == 0 and int(c) > 4) for k, c in enumerate(reversed(digits)))
    return str(-total % 10)


class _Planter:
    """Sentences with a value in them, which is personal data or only looks like it."""

    FILL = "the of and to in that it is was on are as with they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()
    LEADS = {
        "email": ["mail", "e-mail:", "contact", "write to", "reach me under", "send it to", "", ""], "phone": ["tel.", "phone:", "call", "fax", "mobile", "please ring", "dial", "SMS to"],
        "card": ["card", "Visa", "credit card no", "paid with", "charged to", ""], "ip": ["host", "server", "IP", "ping", "logged in from", ""],
        "secret": ["token =", "api_key:", "password=", "secret:", "Authorization: Bearer", "access key", "auth token", "private_key ="],
    }
    PLAIN = {
        "phone": ["order", "invoice no", "ISBN", "ref", "ticket", "a total of", "from", "serial", "item", "", ""], "card": ["order", "serial", "id", "card", "Visa", "phone", "tel.", "server", "", ""], "ip": ["version", "section", "build", ""],
        "email": ["meet", "see", "user", "", ""], "secret": ["commit", "sha256:", "md5", "checksum", "etag", "revision", "file", "", "", ""],
    }

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def digits(self, n: int) -> str:
        return "".join(self.rng.choices("0123456789", k=n))

    def shaped(self, shape: str) -> str:
        return "".join(self.digits(1) if c == "d" else c for c in shape)

    def word(self, n: int = 0) -> str:
        return "".join(self.rng.choices("abcdefghijklmnoprstuvw", k=n or self.rng.randrange(3, 9)))

    def text(self, alphabet: str, *lengths: int) -> str:
        return "".join(self.rng.choices(alphabet, k=self.rng.choice(lengths)))

    def card(self, right: bool) -> str:
        body = self.digits(15)
        end = _luhn_digit(body)
        digits = body + (end if right else str((int(end) + self.rng.randrange(1, 10)) % 10))
        return self.rng.choice([".", "/"] if right else [".", "/", " ", "-", ""]).join(digits[k : k + 4] for k in range(0, 16, 4))

    def value(self, kind: str) -> str:
        pick, w = self.rng.choice, self.word
        if kind == "email":
            at, dot = pick([("(at)", "."), ("[at]", "."), (" (at) ", "."), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" {at} ", ".")])
            local = pick([w(), w() + pick([".", "_", "-"]) + w(), w(1) + pick([".", ""]) + w()])
            return f"{local}{pick(['', '', self.digits(2)])}{at}{w()}{pick(['', '.' + w()]) if dot == '.' else ''}{dot}{pick(['com', 'org', 'net', 'example', 'co'])}"
        if kind == "phone":
            return self.shaped(pick(["(ddd) ddd-dddd", "ddd-ddd-dddd", "ddd.ddd.dddd", "0dd dddd dddd", "0dddd ddd ddd", "0dddd/dddddd", "00 dd dd dddd dddd", "(0dd) dddd dddd", "dddddddddd", "ddd ddd dddd"]))
        if kind == "card":
            return self.card(True)
        if kind == "ip":
            return pick(["[.]", "(.)"]).join(str(self.rng.randrange(256)) for _ in range(4))
        if pick([0, 1]):
            out = self.text(pick(["0123456789abcdef", "0123456789ABCDEF"]), 32, 40, 48, 64)
        else:
            out = pick(["", "sk_live_", "key-", "AK"]) + self.text("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + pick(["", "+/", "_-"]), 20, 24, 32, 40)
        return f'"{out}"' if self.rng.random() < 0.4 else out

    def lookalike(self, kind: str) -> str:
        pick, w = self.rng.choice, self.word
        if kind == "email":
            return pick([f"{w()} {pick(['(at)', '[at]'])} {w()}", f"{w()} {w()}(at){w()}", f"{w()}@{w()}", f"@{w()}@{w()}", f"{self.digits(1)}@{self.digits(1)}", f"https://{w()}@{w()}"])
        if kind == "phone":
            return self.shaped(pick(["dddddddddddd", "20dd-dddd-dddd", "978-d-dd-dddddd-d", "19dd to 20dd", "d dddd dddd", "dd.dd.dd.dd", "ddddd-dddd", "20dd-0d-dd", "dddd dddd dddd", "dddddddddd", "ddd ddd"]))
        if kind == "card":
            return pick([self.card(False), self.digits(pick([8, 12, 14, 17, 20, 24]))])
        if kind == "ip":
            return pick(["[.]", "(.)"]).join(str(self.rng.randrange(256, 1000)) for _ in range(4)) if pick([0, 1]) else self.shaped("d.dd.dddd.d")
        hexes = self.text("0123456789abcdef", 32, 40, 64)
        return pick([hexes, hexes, f"{self.text('0123456789abcdef', 8)}-{self.text('0123456789abcdef', 4)}-4{self.text('0123456789abcdef', 3)}-{self.text('0123456789abcdef', 12)}", "_".join(w() for _ in range(4)), "-".join(w() for _ in range(3)) + "-" + self.digits(4), w(18), w(20) + self.digits(1), w(9) + "/" + w(9) + "/" + self.digits(2), w(300)])

    def row(self) -> tuple[str, int, str]:
        """text, whether its value is personal data, and the value, with # for its kind's number before it."""
        kind, is_one = self.rng.choice(KINDS), self.rng.random() < 0.5
        value = self.value(kind) if is_one else self.lookalike(kind)
        lead = self.rng.choice((self.LEADS if is_one else self.PLAIN)[kind])
        if is_one and kind == "phone" and "(" in value and self.rng.random() < 0.3:
            lead = ""
        if is_one and kind in ("email", "card", "ip") and self.rng.random() < 0.2:
            lead = ""
        case = self.rng.choice([str, str, str.lower, str.upper, str.capitalize])
        fill = [self.rng.choice(self.FILL) for _ in range(self.rng.randrange(8, 24))]
        at = self.rng.randrange(3, len(fill) - 1)
        before, after = case(" ".join(fill[:at] + [lead] * (lead != ""))), case(" ".join(fill[at:]))
        gap = "" if lead.endswith("=") and self.rng.random() < 0.5 else " "
        end = self.rng.choice(["", ".", ",", ";", "!!"])
        return before + gap + value + end + " " + after, KINDS.index(kind) if is_one else -1, value.strip('"')


def examples(n: int = EXAMPLES, seed: int = 5) -> list[tuple[int, str, int, str]]:
    """(number, text, kind or -1, value) of planted sentences."""
    planter = _Planter(seed)
    return [(k, *planter.row()) for k in range(n)]


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value made once."""
    return F.transform(F.array(value), then)[0]


def _running(values: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each value what add makes of those before it, from zero; add must not mind where it begins."""
    none = F.slice(F.array(zero), 1, 0)
    over = lambda xs, value: F.aggregate(xs, F.struct(zero.alias("at"), none.alias("out")), lambda a, x: F.struct(add(a["at"], value(x)).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))
    cut = lambda v: F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(v) - 1, F.lit(0)) / BLOCK).cast("int")), lambda b: over(F.slice(v, b * BLOCK + 1, BLOCK), lambda x: x))
    whole = lambda inner: F.flatten(F.zip_with(inner, over(inner, lambda y: y["at"])["out"], lambda y, s: F.transform(y["out"], lambda z: add(s, z))))
    return _let(values, lambda v: _let(cut(v), whole))


_SPAN = "struct<start:bigint,end:bigint,start_byte:bigint,end_byte:bigint,text:string,before:string,after:string>"


def _matches(text: Column, pattern: str) -> Column:
    """array<_SPAN> of a pattern's matches: places in code points and bytes, and the text on either side up to the neighbouring match.

    split() and regexp_extract_all() walk the same matches, so the lengths of what stands
    between and of the matches add up to the places.
    """
    size = lambda x: F.struct(F.length(x).cast("long").alias("c"), F.octet_length(x).cast("long").alias("b"))
    plus = lambda a, b: F.struct((a["c"] + b["c"]).alias("c"), (a["b"] + b["b"]).alias("b"))
    zero = F.struct(F.lit(0).cast("long").alias("c"), F.lit(0).cast("long").alias("b"))

    def placed(v: Column) -> Column:
        lengths = F.transform(v["hits"], lambda h, i: plus(size(v["gaps"][i]), size(h)))

        def span(h: Column, i: Column, starts: Column) -> Column:
            at, gap, own = starts[i], size(v["gaps"][i]), size(h)
            start = plus(at, gap)
            end = plus(start, own)
            return F.struct(
                start["c"].alias("start"), end["c"].alias("end"), start["b"].alias("start_byte"), end["b"].alias("end_byte"), h.alias("text"),
                F.lower(F.right(v["gaps"][i], F.lit(CONTEXT))).alias("before"), F.left(v["gaps"][i + 1], F.lit(1)).alias("after"),
            )

        return _let(_running(lengths, zero, plus), lambda starts: F.transform(v["hits"], lambda h, i: span(h, i, starts)))

    found = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    none = F.array().cast(f"array<{_SPAN}>")
    return _let(found, lambda v: F.when(F.size(v["hits"]) == 0, none).otherwise(placed(v)))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The checksum of a string of digits holds."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _small_parts(text: Column) -> Column:
    """Every number of a dotted run is 255 at most, leading zeros aside."""
    return text.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$))+$")


def _holds(kind: str, text: Column) -> Column:
    n = F.length(_digits(text))
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(_digits(text))).otherwise(False)
    return {"email": F.lit(True), "ip": _small_parts(text), "phone": n.between(9, 15)}[kind]


def _may_hold(kind: str, text: Column) -> Column:
    """A cheap look that spares most texts the patterns."""
    return text.contains("@") | text.rlike(r"(?i)[\[({]at[\])}]") if kind == "email" else text.rlike("[0-9]")


def _found(text: Column, patterns: dict[str, str], kind: str) -> Column:
    none = F.array().cast(f"array<struct<kind:int,{_SPAN[7:]}>")
    mine = F.transform(_matches(text, patterns[kind]), lambda x: F.struct(F.lit(KINDS.index(kind)).alias("kind"), *[x[c].alias(c) for c in ("start", "end", "start_byte", "end_byte", "text", "before", "after")]))
    return F.when(_may_hold(kind, text), mine).otherwise(none)


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, start_byte, end_byte, text, before, after>> of the base rules, by kind and start."""
    sure = lambda kind: F.filter(_found(text, BASE, kind), lambda x: _holds(kind, x.text))
    return F.concat(*map(sure, BASE))


def _features(x: Column) -> dict[str, Column]:
    s, digits, before = x["text"], _digits(x["text"]), x["before"]
    parts = F.regexp_extract_all(s, F.lit("[0-9]+"), F.lit(0))
    n = F.length(digits)
    count = lambda c: F.length(F.regexp_replace(s, c, ""))
    out = {
        "kind": x["kind"], "n_chars": F.length(s), "n_digits": n, "n_letters": count("[^A-Za-z]"), "n_marks": count("[A-Za-z0-9]"), "n_dots": count("[^.]"), "n_upper": count("[^A-Z]"),
        "plus": s.startswith("+"), "paren": s.contains("("), "at": s.contains("@"), "named": s.rlike(r"[A-Za-z]\w*(?:\.|\x20?[\[({]dot[\])}]\x20?)[A-Za-z]{2,}$"), "hex": s.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "luhn": F.when(n.between(2, 30), _luhn(digits)).otherwise(False),
        "top_part": F.aggregate(parts, F.lit(0), lambda a, p: F.greatest(a, F.least(F.coalesce(F.substring(p, 1, 6).try_cast("int"), F.lit(0)), F.lit(1000)))),
        "groups": F.size(parts), "longest": F.aggregate(parts, F.lit(0), lambda a, p: F.greatest(a, F.length(p))),
        "word_before": before.rlike(r"[a-z0-9]$"), "quote_before": before.rlike(r"[\"'`]$"), "sign_before": before.rlike(r"[=:][\s\"'`]*$"), "word_after": x["after"].rlike("[A-Za-z0-9]"),
    }
    out |= {k: before.rlike(p) for k, p in CUES.items()}
    return {k: F.coalesce(out[k].cast("double"), F.lit(0.0)) for k in FEATURES}


def candidates(text: Column) -> Column:
    """array<struct<kind, start, end, start_byte, end_byte, text, f: struct of FEATURES>> of all proposals."""
    worth = {"email": lambda x: F.lit(True), "secret": lambda x: x["text"].rlike("[0-9]") & x["text"].rlike("[A-Za-z]")}
    numbers = lambda x: F.length(_digits(x["text"])).between(4, 40)
    proposed = F.concat(*[F.filter(_found(text, GENERATORS, k), worth.get(k, numbers)) for k in KINDS])
    return F.transform(proposed, lambda x: F.struct(*[x[c].alias(c) for c in ("kind", "start", "end", "start_byte", "end_byte", "text")], F.struct(*[c.alias(k) for k, c in _features(x).items()]).alias("f")))


@dataclass
class Trees:
    """Boosted trees as plain values: (weight, tree) with tree = prediction or (feature, at most, left, right)."""

    trees: list
    thresholds: dict[str, float]

    def score(self, f: Column) -> Column:
        def walk(t) -> Column:
            if isinstance(t, float):
                return F.lit(t)
            k, most, left, right = t
            return F.when(f[FEATURES[k]] <= most, walk(left)).otherwise(walk(right))

        margin = F.lit(0.0)
        for weight, tree in self.trees:
            margin = margin + F.lit(weight) * walk(tree)
        return 1 / (1 + F.exp(-2 * margin))

    def threshold(self, kind: Column) -> Column:
        out = F.lit(2.0)
        for k, name in enumerate(KINDS):
            out = F.when(kind == k, F.lit(self.thresholds[name])).otherwise(out)
        return out


def _exported(node):
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (split.featureIndex(), float(split.threshold()), _exported(node.leftChild()), _exported(node.rightChild()))


def training_rows(spark: SparkSession, n: int = EXAMPLES, seed: int = 5) -> DataFrame:
    """Labelled candidates of planted examples: label, FEATURES, part (0 to 9 by sentence; 7 and above are held out).

    A candidate is one if its kind and text are the planted value's; every other candidate in
    the sentences is none. The base rules take no part in the labels, and candidates that
    they decide alone aren't used.
    """
    rows = spark.createDataFrame(examples(n, seed), "n int, text string, kind int, value string")
    each = rows.select("n", "kind", "value", base_spans(F.col("text")).alias("base"), F.explode(candidates(F.col("text"))).alias("x"))
    sure = F.exists("base", lambda b: (b.kind == F.col("x.kind")) & (b.start < F.col("x.end")) & (F.col("x.start") < b.end))
    trim = lambda c: F.regexp_replace(c, "^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "")
    label = (F.col("x.kind") == F.col("kind")) & (trim(F.col("x.text")) == trim(F.col("value")))
    return each.where(~sure).select(label.cast("double").alias("label"), F.pmod(F.xxhash64("n"), F.lit(10)).alias("part"), *[F.col(f"x.f.{k}").alias(k) for k in FEATURES])


_fitted: dict[int, Trees] = {}


def fit(spark: SparkSession, n: int = EXAMPLES) -> Trees:
    """Trees and thresholds from n planted examples; no part of it depends on the corpus, so a driver fits once."""
    if n not in _fitted:
        _fitted[n] = _fit(spark, n)
    return _fitted[n]


def _fit(spark: SparkSession, n: int) -> Trees:
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    table = written(training_rows(spark, n), "candidates").coalesce(1).cache()  # a few thousand rows, read by each tree
    model = GBTClassifier(featuresCol="v", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=32, seed=7).fit(
        VectorAssembler(inputCols=FEATURES, outputCol="v").transform(table.where("part < 7"))
    )
    trees = [(float(w), _exported(t._java_obj.rootNode())) for w, t in zip(model.treeWeights, model.trees)]
    out = Trees(trees, {})
    bins = (
        table.where("part >= 7")
        .select("kind", "label", F.floor(out.score(F.struct(*FEATURES)) * 100).alias("bin"))
        .groupBy("kind", "bin")
        .agg(F.sum("label").alias("hits"), F.count("*").alias("n"))
        .collect()  # 101 bins of each kind at most
    )
    for k, name in enumerate(KINDS):
        hits, n_over, best = 0, 0, 1.01
        for b in sorted((b for b in bins if b.kind == k), key=lambda b: -b.bin):
            hits, n_over = hits + b.hits, n_over + b.n
            if hits >= PRECISION * n_over and b.bin >= 100 * LEAST:
                best = b.bin / 100
        out.thresholds[name] = best
    table.unpersist()
    return out


def _apart(base: Column, added: Column) -> Column:
    """The added spans, by start, that overlap no base span and don't lie within a better neighbour; others may overlap, so nothing found is lost."""
    known = F.transform(base, lambda b: F.struct(b.start.alias("start"), b.end.alias("end"), F.lit(True).alias("base"), b.kind.alias("kind"), F.lit(1.0).alias("p"), b.start_byte.alias("start_byte"), b.end_byte.alias("end_byte")))
    new = F.transform(added, lambda x: F.struct(x.start.alias("start"), x.end.alias("end"), F.lit(False).alias("base"), x.kind.alias("kind"), x.p.alias("p"), x.start_byte.alias("start_byte"), x.end_byte.alias("end_byte")))
    low, high = F.lit(-1).cast("long"), F.lit(1 << 62)

    def free(v: Column) -> Column:
        ends = _running(F.transform(v, lambda x: F.when(x.base, x.end).otherwise(low)), low, lambda a, b: F.greatest(a, b))
        starts = F.reverse(_running(F.transform(F.reverse(v), lambda x: F.when(x.base, x.start).otherwise(high)), high, lambda a, b: F.least(a, b)))
        both = F.struct(ends.alias("ends"), starts.alias("starts"))
        return _let(both, lambda w: F.filter(v, lambda x, i: ~x.base & (w["ends"][i] <= x.start) & (w["starts"][i] >= x.end)))

    def best(v: Column) -> Column:
        worse = lambda x, y: F.coalesce((x.start >= y.start) & (x.end <= y.end) & ((y.p > x.p) | ((y.p == x.p) & ((y.kind < x.kind) | ((y.kind == x.kind) & (y.start < x.start))))), F.lit(False))
        return F.filter(v, lambda x, i: ~worse(x, F.get(v, i - 1)) & ~worse(x, F.get(v, i + 1)))

    return _let(_let(F.array_sort(F.concat(known, new)), free), best)


def find(docs: DataFrame, model: Trees) -> DataFrame:
    """Adds base and spans, both array<struct<kind, start, end, start_byte, end_byte>>, to docs, which must have a text column.

    base are the base rules' spans by kind and start; spans are those and the candidates at
    or above their kind's threshold that overlap no base span, nor lie, in order of their starts, within a
    better candidate beside them. Added spans that overlap only in part all stay; redact() takes such a run as one. A null or empty text has none. Rows, their order and their other
    columns stay; columns named base, spans or _added are replaced.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cut = lambda a: F.transform(a, lambda x: F.struct(x.kind, x.start, x.end, x.start_byte, x.end_byte))
    rows = docs.drop("base", "spans").withColumn("base", cut(base_spans(text)))
    scored = F.transform(candidates(text), lambda x: F.struct(x.kind, x.start, x.end, x.start_byte, x.end_byte, model.score(x.f).alias("p")))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,start_byte:bigint,end_byte:bigint,p:double>>")
    rows = rows.withColumn("_added", F.when(_may_hold("email", text) | _may_hold("phone", text), F.filter(scored, lambda x: x.p >= model.threshold(x.kind))).otherwise(none))
    spans = F.when(F.size("_added") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", cut(_apart(F.col("base"), F.col("_added"))))))
    return rows.withColumn("spans", spans).drop("_added")


def redact(text: Column, spans: Column) -> Column:
    """text with each run of overlapping spans replaced by the first one's kind, as in <EMAIL>; spans are those of find()."""
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x.start_byte.alias("start"), x.end_byte.alias("end"), x.kind.alias("kind"))))
    zero = F.lit(0).cast("long")

    def clean(v: Column) -> Column:
        piece = lambda a, n: F.decode(F.substring(v["data"], (a + 1).cast("int"), n.cast("int")), "utf-8")
        ends = _running(F.transform(v["spans"], lambda x: x.end), zero, lambda a, b: F.greatest(a, b))
        kept = lambda e: F.transform(v["spans"], lambda x, i: F.when(x.start >= e[i], F.concat(piece(e[i], x.start - e[i]), F.element_at(tags, x.kind + 1))))
        last = F.array_max(F.transform(v["spans"], lambda x: x.end))
        return F.concat(F.array_join(F.filter(_let(ends, kept), lambda x: x.isNotNull()), ""), piece(last, F.octet_length(v["data"]) - last))

    both = F.struct(F.encode(text, "utf-8").alias("data"), ordered.alias("spans"))
    return F.when(F.size(spans) > 0, _let(both, clean)).otherwise(text)
