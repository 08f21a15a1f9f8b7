"""Personal data: strict spans, and more spans chosen by boosted trees over candidates of loose patterns.

Loose patterns propose spans, several of which may cover the same characters. Each has features of its form and of the text
around it, none of the way it is written (plus, dots, gaps), which would only tell the strict form. Trees are boosted on the
candidates of all documents. Their labels are evidence that holds for any form: check sum, octets, number of digits, cue
words of the kind before it, or a value that some document also holds in strict form. Per kind the score that keeps the wanted
precision is the threshold. Candidates above it are added to the strict spans, which always stay.

Patterns never start inside a run they have already tried, and repeat groups only possessively, so one very long run of
letters or digits costs linear time and no stack.
"""
from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthloom.session import stage

KINDS = ("email", "ip", "card", "phone")
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?:\G|(?<![^\s@]))[^\s@]++@[^\s@]++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:[.,:][0-9]++){3,7}+",
    "card": r"(?<![0-9])[0-9](?:[ ./-]{0,2}[0-9]){11,19}+(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|\(|00)?[0-9](?:[ ()./-]{0,2}[0-9]){6,15}+(?![0-9])",
}
SIGN = {"email": "@", "ip": None, "card": None, "phone": None}  # what a loose span cannot be without
CUES = {"email": "mail|contact|address", "ip": r"\bip\b|host|server|address", "card": "card|visa|account|payment", "phone": r"phone|\btel|call|mobile|fax|contact"}
ADDRESS = r"^[\p{L}\p{N}._%+-]++@[\p{L}\p{N}.-]++(?<=[\p{L}\p{N}]\.\p{L}{2,24})$"
ROUNDS, RATE = 30, 0.3
PRECISION = 0.98  # of the candidates above a kind's threshold
FEATURES = ("kind", "digits", "parts", "small_parts", "luhn", "fits", "joined_left", "joined_right", "cue")
SPAN = "array<struct<s:int,e:int,m:string>>"


def spans_of(text: Column, pattern: str) -> Column:
    """Matches from left to right with start and end in code points. Needs time in the square of a text's matches."""
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("m")))

    def place(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        end = (start + F.coalesce(F.length(x["m"]), F.lit(0))).cast("int")
        one = F.array(F.struct(start.cast("int").alias("s"), end.alias("e"), x["m"].alias("m")))
        return F.struct(end.alias("at"), F.when(x["m"].isNull(), done["out"]).otherwise(F.concat(done["out"], one)).alias("out"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")), place, lambda done: done["out"])


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether the digits of a string, 20 at most, pass the check sum."""
    padded = F.lpad(digits_of(m), 20, "0")
    total = F.lit(0)
    for i in range(20):
        d = F.substring(padded, i + 1, 1).cast("int")
        total = total + (d if i % 2 else F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    return total % 10 == 0


def small_parts(m: Column, separator: str) -> Column:
    """Whether all parts are numbers of at most 255, leading zeros aside."""
    bare = F.transform(F.split(m, separator), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(bare, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))


def strict_spans(text: Column, kind: str) -> Column:
    """The base spans of one kind."""
    found = spans_of(text, STRICT[kind])
    if kind == "ip":
        found = F.filter(found, lambda x: small_parts(x["m"], r"\."))
    if kind == "card":
        found = F.filter(found, lambda x: luhn(x["m"]))
    if kind == "phone":
        found = F.filter(found, lambda x: F.length(digits_of(x["m"])).between(9, 15))
    need = {"email": text.contains("@"), "ip": text.contains("."), "card": text.rlike("[0-9]"), "phone": text.contains("+")}[kind]
    return F.when(need, found).otherwise(F.array().cast(SPAN))


def _fits(m: Column, kind: str) -> Column:
    """Whether a span holds what its kind needs, however it is written."""
    digits = digits_of(m)
    if kind == "email":
        return m.rlike(ADDRESS)
    if kind == "ip":
        return small_parts(m, "[^0-9]+") & (F.regexp_count(m, F.lit("[0-9]++")) == 4)
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(F.substring(digits, 1, 20))
    return F.length(digits).between(7, 15)


def _features(text: Column, kind: int, x: Column) -> Column:
    m, flag = x["m"], lambda c: c.cast("int")
    return F.struct(
        x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"), F.least(F.length(digits_of(m)), F.lit(30)).alias("digits"),
        F.least(F.regexp_count(m, F.lit("[0-9]++")), F.lit(10)).alias("parts"), flag(small_parts(m, "[^0-9]+")).alias("small_parts"),
        flag(luhn(F.substring(digits_of(m), 1, 20))).alias("luhn"), flag(_fits(m, KINDS[kind])).alias("fits"),
        flag(F.substring(text, x["s"], F.lit(1)).rlike(r"[\p{L}\p{N}_]") & (x["s"] > 0)).alias("joined_left"),
        flag(F.substring(text, x["e"] + 1, F.lit(1)).rlike(r"[\p{L}\p{N}_]")).alias("joined_right"),
        flag(F.lower(F.substring(text, F.greatest(x["s"] - 23, F.lit(1)), F.least(x["s"], F.lit(24)))).rlike(CUES[KINDS[kind]])).alias("cue"),
    )


def _of_kind(text: Column, kind: int):
    return lambda x: _features(text, kind, x)


def candidates(docs: DataFrame) -> DataFrame:
    """Documents with their strict spans (one array per kind) and `__loose`, the candidates with their features."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumns({f"__{k}": strict_spans(text, k) for k in KINDS})
    digit = text.rlike("[0-9]")
    loose = [F.when(digit if SIGN[k] is None else text.contains(SIGN[k]), spans_of(text, LOOSE[k])) for k in KINDS]
    none = F.array().cast(SPAN)
    out = out.withColumns({f"__l_{k}": F.coalesce(c, none) for k, c in zip(KINDS, loose, strict=True)})
    made = [F.transform(f"__l_{k}", _of_kind(text, i)) for i, k in enumerate(KINDS)]
    return out.withColumn("__loose", F.concat(*made)).drop(*[f"__l_{k}" for k in KINDS])


def _is_strict(x: Column) -> Column:
    """Whether a candidate is a strict span of its kind."""
    hits = [(x["kind"] == i) & F.exists(f"__{k}", lambda b: (b["s"] == x["s"]) & (b["e"] == x["e"])) for i, k in enumerate(KINDS)]
    return reduce(lambda a, b: a | b, hits)


def _evidence(x: Column) -> Column:
    """Whether a candidate is personal data of its kind in whatever form, by what it holds and what is said before it."""
    kinds = [KINDS.index(k) for k in ("ip", "phone")]  # plain numbers are these too: only a cue word tells
    return (x["fits"] == 1) & (~x["kind"].isin(kinds) | (x["cue"] == 1))


def value_of(m: Column) -> Column:
    """What a span says in any form: its numbers without the signs between them, an address in small letters."""
    octets = F.array_join(F.transform(F.regexp_extract_all(m, F.lit("([0-9]++)")), lambda p: F.regexp_replace(p, "^0+(?=.)", "")), ".")
    return F.when(m.contains("@"), F.lower(m)).when(m.rlike(r"^[0-9]{1,3}([.,:][0-9]{1,3}){3}$"), octets).otherwise(F.regexp_replace(digits_of(m), "^0+", ""))


class Trees:
    """Boosted trees of two levels over small whole numbers, and a threshold per kind."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, precision: float = PRECISION):
        positive = float((weight * y).sum() / weight.sum())
        self.start = float(np.log(max(positive, 1e-6) / max(1 - positive, 1e-6)))
        self.trees, score = [], np.full(len(y), self.start)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (y - p), weight * p * (1 - p)
            everything = np.ones(len(y), dtype=bool)
            root = self._split(x, g, h, everything)
            if root is None:
                break
            tree = [root]
            right = x[:, root[0]] > root[1]
            for side in (~right, right):
                leaf = self._split(x, g, h, side)
                low = high = side
                if leaf is not None:
                    low, high = side & (x[:, leaf[0]] <= leaf[1]), side & (x[:, leaf[0]] > leaf[1])
                values = [rate * float(g[s].sum() / (h[s].sum() + 1)) for s in (low, high)]
                if leaf is None:
                    leaf, values = (0, 10**6), [values[0], values[0]]
                score[low] += values[0]
                if leaf[1] < 10**6:
                    score[high] += values[1]
                tree.append((*leaf, *values))
            self.trees.append(tree)
        self.thresholds = []
        for kind in range(len(KINDS)):
            mine = np.flatnonzero(x[:, 0] == kind)
            order = mine[np.argsort(-score[mine], kind="stable")]
            right_so_far, all_so_far = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
            last = np.append(np.diff(score[order]) != 0, True) if len(order) else np.empty(0, dtype=bool)  # ties stand or fall together
            good = np.flatnonzero(last & (right_so_far >= precision * all_so_far)) if len(order) else []
            self.thresholds.append(float(score[order[good[-1]]]) if len(good) else float("inf"))

    @staticmethod
    def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray):
        best, found = 1e-6, None
        for f in range(x.shape[1]):
            v = x[rows, f]
            if not len(v):
                return None
            top = int(v.max()) + 1
            gs, hs = np.cumsum(np.bincount(v, g[rows], top)), np.cumsum(np.bincount(v, h[rows], top))
            gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
            at = int(gain[:-1].argmax()) if top > 1 else -1
            if at >= 0 and gain[at] > best:
                best, found = float(gain[at]), (f, at)
        return found

    def score(self, x: Column) -> Column:
        """The trees as one SQL expression over a candidate."""
        total = F.lit(self.start)
        for (f, cut), (lf, lc, l0, l1), (rf, rc, r0, r1) in self.trees:
            low = F.when(x[FEATURES[lf]] <= lc, l0).otherwise(l1)
            high = F.when(x[FEATURES[rf]] <= rc, r0).otherwise(r1)
            total = total + F.when(x[FEATURES[f]] <= cut, low).otherwise(high)
        return total

    def chosen(self, x: Column) -> Column:
        limit = F.lit(float("inf"))
        for i, t in enumerate(self.thresholds):
            limit = F.when(x["kind"] == i, F.lit(t)).otherwise(limit)
        return self.score(x) >= limit


def _base(kind: int):
    """A strict span as a row beside the candidates: its value only."""
    return lambda x: F.struct(F.lit(True).alias("base"), F.lit(kind).alias("kind"), *[F.lit(0).alias(f) for f in FEATURES[1:]],
                              F.md5(value_of(x["m"])).alias("value"), F.lit(False).alias("sure"))


def examples(docs: DataFrame) -> DataFrame:
    """(features, y, count): the candidates of all documents by their features and label.

    Equal rows are counted before values meet: one that every document holds is no task's burden.
    """
    found = candidates(docs.select("doc_id", "text"))
    value = lambda x: F.md5(value_of(F.substring("text", x["s"] + 1, x["e"] - x["s"])))
    loose = F.transform("__loose", lambda x: F.struct(
        F.lit(False).alias("base"), *[x[f].alias(f) for f in FEATURES], value(x).alias("value"), (_is_strict(x) | _evidence(x)).alias("sure")))
    every = F.concat(loose, *[F.transform(f"__{k}", _base(i)) for i, k in enumerate(KINDS)])
    rows = found.select(F.explode(every).alias("x")).select("x.*")
    counted = stage(rows.groupBy("base", *FEATURES, "value", "sure").agg(F.count(F.lit(1)).alias("n")), "pii-candidates")
    seen = counted.where("base").select("kind", "value").distinct().withColumn("seen", F.lit(1))
    labelled = counted.where("not base").join(seen, ["kind", "value"], "left").withColumn("y", (F.col("sure") | F.col("seen").isNotNull()).cast("int"))
    return labelled.groupBy(*FEATURES, "y").agg(F.sum("n").alias("count"))


def fit(docs: DataFrame) -> Trees | None:
    """Trees fitted on the candidates of all documents; None without candidates.

    What reaches the driver does not grow with them: features are small whole numbers, of which there are few combinations.
    """
    counted = examples(docs).orderBy(F.desc("count"), *FEATURES, "y").collect()
    if not counted:
        return None
    x = np.array([[r[f] for f in FEATURES] for r in counted], dtype=np.int64)
    return Trees(x, np.array([r["y"] for r in counted], dtype=float), np.array([r["count"] for r in counted], dtype=float))


def find(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """Documents with base and spans: arrays of (kind number, s, e) by kind and start; other columns stay.

    `base` holds the strict spans, `spans` those and the chosen candidates. Offsets count code points, the end is exclusive.
    A null text has no spans.
    """
    kept = [c for c in docs.columns if c not in ("base", "spans")]
    out = candidates(docs.select(*kept))

    def plain(kind=None):
        return lambda x: F.struct((x["kind"] if kind is None else F.lit(kind)).alias("kind"), x["s"].alias("s"), x["e"].alias("e"))

    base = F.concat(*[F.transform(f"__{k}", plain(i)) for i, k in enumerate(KINDS)])
    more = F.filter("__loose", trees.chosen) if trees else F.filter("__loose", lambda x: F.lit(False))
    out = out.withColumns({"base": base, "__more": F.transform(more, plain())})
    return out.select(*kept, "base", F.array_sort(F.array_distinct(F.concat("base", "__more"))).alias("spans"))


def count_of(spans: str, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda x: x["kind"] == number)).cast("long")


def written(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"], x["e"])), ",")


def redacted(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """Documents with every span of the text replaced by its kind in brackets; of spans that overlap the first by start."""
    found = find(docs, trees)
    order = F.array_sort(F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def step(done: Column, x: Column) -> Column:
        skip = x["s"] < done["at"]
        part = F.concat(done["out"], F.substring("text", done["at"] + 1, x["s"] - done["at"]), F.get(names, x["kind"]))
        return F.struct(F.when(skip, F.greatest(done["at"], x["e"])).otherwise(x["e"]).alias("at"), F.when(skip, done["out"]).otherwise(part).alias("out"))

    text = F.aggregate(order, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda done: F.concat(done["out"], F.substring("text", done["at"] + 1, F.length("text"))))
    return found.withColumn("text", text).select(*docs.columns)
