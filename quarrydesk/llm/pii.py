"""Personal data by weak supervision, in Spark SQL functions alone.

Fixed patterns find base spans, which always stay. Looser patterns propose more spans. Labelers look at every
candidate: the fixed pattern, a gazetteer of endings and prefixes, words before it, its shape, its edges. Expectation-
maximisation over their votes estimates each labeler's reliability for each kind, and a logistic span classifier
trained on the resulting posteriors decides which looser spans are added.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]

# --- fixed values: the base patterns, written so that no text makes them slow -------------------------------------
# A match starts where no shorter start could have begun (look-behind) or right after the last match (\G).
_LOCAL, _DIGITS = "[A-Za-z0-9._%+-]", "[0-9]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"(?<!{_DIGITS}){_DIGITS}++(?:\.{_DIGITS}++){{3}}",
    "card": rf"(?<!{_DIGITS})(?<!{_DIGITS}[\x20-]){_DIGITS}(?:[\x20-]?{_DIGITS}){{13,}}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++\x20?(?:\(at\)|\[at\]|\{{at\}})\x20?[A-Za-z0-9-]++(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z-])[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{1,7}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
}
GAZETTEER = {
    "email": r"(?i)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$",
    "ip": r"^(?:10|127|172|192|2001|fe80|fd00)[.:]",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^(?:\+(?:1|33|34|44|49)\b|\(?[2-9])",
}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|correo|courriel)\b[^\n]*$",
    "ip": r"(?i)\b(?:ip|host|server|address|addr|adresse)\b[^\n]*$",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|carte|tarjeta|karte|credit)\b[^\n]*$",
    "phone": r"(?i)\b(?:phone|tel|telephone|mobile|call|fax|telefon|tel[eé]fono|t[eé]l[eé]phone|handy|m[oó]vil|portable|anrufen|llamar|appelez)\b[^\n]*$",
}
SHAPE = {"email": r"^[^\s]{6,80}$", "ip": r"^[0-9A-Fa-f.:]{7,39}$", "card": r"^(?:[0-9]{14,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7})$",
         "phone": r"^\+?[0-9(][0-9]{0,3}[\x20().-]*[0-9\x20().-]{7,18}$"}
CONTEXT_CHARS = 32
LONG = {"email": 30, "ip": 30, "card": 18, "phone": 13}
# ------------------------------------------------------------------------------------------------------------------
LABELERS = ["pattern", "gazetteer", "context", "shape", "edges"]
#: What only the span classifier sees: length, share of digits, marks and line starts before, neighbours on both sides.
FEATURES = ["long", "digits", "marked", "line", "after_digit", "before_letter"]
SEEN = [*LABELERS, *FEATURES]
EM_ROUNDS, FIT_ROUNDS, PRIOR = 50, 300, 1.0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return (n >= 14) & (n <= 19) & (F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step) % 10 == 0)


def _small_parts(value: Column) -> Column:
    trimmed = F.transform(F.split(value, r"\."), lambda p: F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))))
    return F.forall(trimmed, lambda p: (F.length(p) <= 4) & (F.left(p, F.lit(4)).cast("int") <= 255))


VALID = {"email": lambda v: F.lit(True), "ip": _small_parts, "card": _luhn,
         "phone": lambda v: F.length(_digits(v)).between(10, 15)}


def _held(value: Column) -> Column:
    """The value as a column of its own: the optimiser does not copy an expression that draws a number into its uses.

    A lambda evaluates what it uses anew for each element, so whatever it uses has to be a held column.
    """
    return F.when(F.rand(0) < 2, value)


def _running(values: Column, zero: Column, combine) -> Column:
    """For each element of a held array what the elements before it combine to; n * sqrt(n) copies, no more.

    Blocks of about sqrt(n) elements are combined one by one, then the blocks; ``combine`` is associative.
    """
    n = F.size(values)
    block = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    none = F.array().cast("array<int>")

    def step(state: Column, x: Column) -> Column:
        return F.struct(combine(state["all"], x).alias("all"), F.concat(state["before"], F.array(state["all"])).alias("before"))

    start = F.struct(zero.alias("all"), none.alias("before"))
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(n / block).cast("int") - 1, F.lit(0))),
                         lambda k: F.aggregate(F.slice(values, k * block + 1, block), start, step))
    offsets = F.aggregate(F.transform(blocks, lambda b: b["all"]), start, step, lambda state: state["before"])
    shifted = F.zip_with(blocks, offsets, lambda b, before: F.transform(b["before"], lambda x: combine(before, x)))
    return F.when(n > 0, F.flatten(shifted)).otherwise(none)


def _with_spans(df: DataFrame, name: str, text: Column, patterns: dict[str, str], needed: dict[str, Column]) -> DataFrame:
    """Adds ``name``: leftmost non-overlapping matches of each kind with code point places, kind by kind.

    Gaps between matches come from a split; places are running sums of gaps and matches.
    """
    empty = F.array().cast("array<struct<gap int, size int, value string>>")
    steps, starts = {}, {}
    for k, kind in enumerate(KINDS):
        matches = F.regexp_extract_all(text, F.lit(patterns[kind]), F.lit(0))
        both = F.zip_with(matches, F.split(text, patterns[kind], -1), lambda m, g: F.struct(
            F.length(g).alias("gap"), F.length(m).alias("size"), m.alias("value")))
        steps[f"{name}_{k}"] = _held(F.when(needed[kind], F.filter(both, lambda x: x["value"].isNotNull())).otherwise(empty))
        starts[f"{name}_{k}_at"] = _held(F.transform(f"{name}_{k}", lambda x: x["gap"] + x["size"]))
    df = df.withColumns(steps).withColumns(starts)
    spans = [F.zip_with(f"{name}_{k}", _running(F.col(f"{name}_{k}_at"), F.lit(0), lambda a, b: a + b), _span(k)) for k in range(len(KINDS))]
    return df.withColumn(name, _held(F.concat(*spans))).drop(*steps, *starts)


def _span(kind: int):
    def made(x: Column, before: Column) -> Column:
        start = before + x["gap"]
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + x["size"]).alias("end"), x["value"].alias("value"))
    return made


def _sorted(spans: Column) -> Column:
    shown = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                                                  s["value"].alias("value")))
    return F.transform(F.array_sort(shown), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                               s["end"].alias("end"), s["value"].alias("value")))


def _apart(df: DataFrame) -> DataFrame:
    """``_pii_loose`` without the spans that overlap one of ``_pii_base``: one pass over both, sorted by start."""
    both = F.concat(*[F.transform(c, lambda s: F.struct(s["start"].alias("start"), F.lit(who).alias("who"), s["end"].alias("end"), s.alias("span")))
                      for who, c in enumerate(("_pii_base", "_pii_loose"))])
    asked = (F.size("_pii_base") > 0) & (F.size("_pii_loose") > 0)
    df = df.withColumn("_pii_both", _held(F.when(asked, F.array_sort(both)).otherwise(F.array_sort(F.slice(both, 1, 0)))))
    far = F.lit(2**31 - 1)
    df = df.withColumns({"_pii_ends": _held(F.transform("_pii_both", lambda m: F.when(m["who"] == 0, m["end"]).otherwise(0))),
                         "_pii_starts": _held(F.reverse(F.transform("_pii_both", lambda m: F.when(m["who"] == 0, m["start"]).otherwise(far))))})
    before = _running(F.col("_pii_ends"), F.lit(0), lambda a, b: F.greatest(a, b))
    after = F.reverse(_running(F.col("_pii_starts"), far, lambda a, b: F.least(a, b)))
    judged = F.zip_with(F.zip_with("_pii_both", before, lambda m, x: F.struct(m.alias("m"), x.alias("before"))), after,
                        lambda m, x: F.struct(m["m"].alias("m"), ((m["m"]["who"] == 1) & (m["before"] <= m["m"]["start"])
                                                                  & (x >= m["m"]["end"])).alias("apart")))
    free = F.transform(F.filter(judged, lambda m: m["apart"]), lambda m: m["m"]["span"])
    return df.withColumn("_pii_loose", _held(F.when(asked, free).otherwise(F.col("_pii_loose")))).drop("_pii_both", "_pii_ends", "_pii_starts")


def _by_kind(kind: Column, tests: list[Column]) -> Column:
    return reduce(lambda rest, k: F.when(kind == k, tests[k]).otherwise(rest), range(len(tests)), F.lit(False))


def votes(chars: Column, span: Column, is_base: bool) -> list[Column]:
    """What each labeler, then each feature of the classifier, says to a candidate: true or false.

    ``chars`` is a held array of the text's code points.
    """
    kind, value = span["kind"], span["value"]
    low = F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0))
    before = F.array_join(F.slice(chars, low + 1, span["start"] - low), "")
    after = F.coalesce(F.get(chars, span["end"]), F.lit(""))
    digits = F.length(_digits(value))
    return [F.lit(is_base),
            _by_kind(kind, [value.rlike(GAZETTEER[k]) for k in KINDS]),
            _by_kind(kind, [before.rlike(CONTEXT[k]) for k in KINDS]),
            _by_kind(kind, [value.rlike(SHAPE[k]) & (VALID[k](value) if k == "card" else F.lit(True)) for k in KINDS]),
            (before.rlike(r"(?:^|[\s(\[<\"':=])$") | (before == "")) & (after.rlike(r"^[\s)\]>\"'.,;:!?]") | (after == "")),
            F.length(value) > _by_kind_number(kind, LONG), digits * 2 > F.length(value), before.rlike(r"[:=#]\s?$"),
            before.rlike(r"(?:^|\n)\s*$") | (before == ""), before.rlike(r"[0-9]\s?$"), after.rlike("^[0-9A-Za-z]")]


def _by_kind_number(kind: Column, values: dict[str, int]) -> Column:
    return reduce(lambda rest, k: F.when(kind == k, values[KINDS[k]]).otherwise(rest), range(len(KINDS)), F.lit(0))


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities of the labelers by kind, and the classifier: by kind a bias and a weight for each vote and feature."""

    reliability: dict[str, dict[str, tuple[float, float]]]
    weights: list[list[float]]

    def probability(self, kind: Column, said: list[Column]) -> Column:
        margins = [reduce(lambda a, b: a + b, [F.when(v, float(w)).otherwise(0.0) for v, w in zip(said, ws[1:])], F.lit(float(ws[0])))
                   for ws in self.weights]
        margin = reduce(lambda rest, k: F.when(kind == k, margins[k]).otherwise(rest), range(len(KINDS)), F.lit(0.0))
        return 1 / (1 + F.exp(-margin))


def fit_votes(patterns: list[tuple[int, tuple[bool, ...], int]]) -> SpanModel:
    """Expectation-maximisation over the labelers' votes, then a logistic fit of votes and features on its posteriors.

    ``patterns``: (kind, votes and features, how many candidates).

    Reliabilities start from voters that are mostly right, and are smoothed, so a kind without candidates keeps them.
    """
    reliability, weights = {}, []
    for k, kind in enumerate(KINDS):
        own = [(np.array(v, float), n) for kk, v, n in patterns if kk == k]
        seen = np.array([v for v, _ in own]).reshape(-1, len(SEEN))
        said = seen[:, :len(LABELERS)]
        n = np.array([c for _, c in own], float)
        yes, no, prior = np.full(len(LABELERS), 0.8), np.full(len(LABELERS), 0.3), 0.5
        post = np.zeros(len(n))
        for _ in range(EM_ROUNDS):
            good = math.log(prior) + said @ np.log(yes) + (1 - said) @ np.log(1 - yes)
            bad = math.log(1 - prior) + said @ np.log(no) + (1 - said) @ np.log(1 - no)
            post = 1 / (1 + np.exp(np.clip(bad - good, -500, 500)))
            post[said[:, 0] == 1] = 1  # what the fixed pattern finds is personal data by definition
            w, u = n * post, n * (1 - post)
            yes = (w @ said + PRIOR * 0.8) / (w.sum() + PRIOR)
            no = (u @ said + PRIOR * 0.3) / (u.sum() + PRIOR)
            prior = (w.sum() + PRIOR * 0.5) / (n.sum() + PRIOR)
            yes, no, prior = np.clip(yes, 0.01, 0.99), np.clip(no, 0.01, 0.99), min(max(prior, 0.01), 0.99)
        reliability[kind] = {name: (float(a), float(b)) for name, a, b in zip(LABELERS, yes, no)}
        # the classifier starts from the reliabilities' log odds, and Newton steps with a pull to them train it
        start = np.append(math.log(prior / (1 - prior)) + np.log((1 - yes) / (1 - no)).sum(),
                          np.log(yes / no) - np.log((1 - yes) / (1 - no)))
        start = np.append(start, np.zeros(len(FEATURES)))
        rows, theta = np.column_stack([np.ones(len(n)), seen]), start.copy()
        for _ in range(FIT_ROUNDS):
            p = 1 / (1 + np.exp(-np.clip(rows @ theta, -30, 30)))
            slope = rows.T @ (n * (post - p)) - (theta - start)
            curve = rows.T @ (rows * (n * p * (1 - p))[:, None]) + np.eye(len(theta))
            move = np.linalg.solve(curve, slope)
            theta += move
            if np.abs(move).max() < 1e-9:
                break
        weights.append([float(x) for x in theta])
    return SpanModel(reliability, weights)


_OWN = ("pii_base", "pii_loose", "pii_spans")


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii_base``, base spans, and ``pii_loose``, looser ones with what labelers and features say to them.

    Spans are (kind number in ``KINDS``, start, end, value), in code points, ends exclusive, by start, then kind;
    ``pii_seen`` has the votes on the base spans. Input columns of these names, and of ``pii_spans``, give way. The work
    grows with the matches of a text and little more, so a text may be one long list.
    """
    docs = docs.drop(*_OWN, "pii_seen")
    text = F.col("_pii_text")
    df = docs.withColumn("_pii_text", _held(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    digit = text.rlike("[0-9]")
    # texts without what a pattern needs are not searched
    df = _with_spans(df, "_pii_base", text, BASE, {"email": text.contains("@"), "ip": digit, "card": digit, "phone": text.contains("+")})
    valid = F.filter("_pii_base", lambda s: _by_kind(s["kind"], [VALID[k](s["value"]) for k in KINDS]))
    df = df.withColumn("_pii_base", _held(_sorted(valid)))
    df = _with_spans(df, "_pii_loose", text, LOOSE, {
        "email": text.rlike(r"(?i)[(\[{]at[)\]}]"), "ip": text.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]"),
        "card": text.rlike(r"[0-9]{4}[\x20-][0-9]{4}"), "phone": text.rlike(r"[0-9]{3}[\x20.-][0-9]{4}")})
    df = _apart(df)
    some = F.size("_pii_base") + F.size("_pii_loose") > 0
    df = df.withColumn("_pii_chars", _held(F.when(some, F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))))

    def seen(is_base: bool):
        return lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
                                  *[v.alias(n) for n, v in zip(SEEN, votes(F.col("_pii_chars"), s, is_base))])

    return df.withColumns({
        "pii_base": F.col("_pii_base"), "pii_loose": F.transform("_pii_loose", seen(False)),
        "pii_seen": F.transform(F.transform("_pii_base", seen(True)), lambda s: F.struct(
            s["kind"].alias("kind"), *[s[n].alias(n) for n in SEEN]))}).drop("_pii_text", "_pii_base", "_pii_loose", "_pii_chars")


def train_spans(found: DataFrame) -> SpanModel:
    """Count what is said to all ``candidates`` of all texts; only those counts (at most 2^11 a kind) reach the driver."""
    loose = F.transform("pii_loose", lambda s: F.struct(s["kind"].alias("kind"), *[s[n].alias(n) for n in SEEN]))
    rows = found.select(F.explode(F.concat("pii_seen", loose)).alias("c")).groupBy("c").agg(F.count("*").alias("n")).collect()
    return fit_votes(sorted((r["c"]["kind"], tuple(bool(r["c"][name]) for name in SEEN), r["n"]) for r in rows))


def find_personal_data(found: DataFrame, model: SpanModel) -> DataFrame:
    """``candidates`` with ``pii_base`` and ``pii_spans``: the base spans and the looser ones that the model takes.

    A null or empty text has none. No row is lost or merged; other columns stay as they are.
    """
    taken = F.filter("pii_loose", lambda s: model.probability(s["kind"], [s[n] for n in SEEN]) >= 0.5)
    plain = F.transform(taken, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                  s["value"].alias("value")))
    return found.withColumn("pii_spans", _sorted(F.concat("pii_base", plain))).drop("pii_loose", "pii_seen")


def masked(df: DataFrame, text_col: str = "text", spans_col: str = "pii_spans") -> DataFrame:
    """``df`` with each span of the text replaced by its kind in brackets; of overlapping spans the first names the hole."""
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    given = F.col(text_col)
    df = df.withColumns({
        "_pii_chars": _held(F.when(F.size(spans_col) > 0, F.regexp_extract_all(given, F.lit("(?s)."), F.lit(0)))),
        "_pii_held": _held(F.col(spans_col))})
    df = df.withColumn("_pii_ends", _held(F.transform("_pii_held", lambda s: s["end"])))
    before = _running(F.col("_pii_ends"), F.lit(0), lambda a, b: F.greatest(a, b))

    def piece(s: Column, at: Column) -> Column:
        gap = F.array_join(F.slice("_pii_chars", at + 1, F.greatest(s["start"] - at, F.lit(0))), "")
        return F.when(s["start"] >= at, F.concat(gap, F.get(names, s["kind"]))).otherwise("")

    last = F.array_max("_pii_ends")
    rest = F.array_join(F.slice("_pii_chars", last + 1, F.greatest(F.size("_pii_chars") - last, F.lit(0))), "")
    clean = F.concat(F.array_join(F.zip_with("_pii_held", before, piece), ""), rest)
    return df.withColumn(text_col, F.when(F.size("_pii_held") > 0, clean).otherwise(given)).drop("_pii_chars", "_pii_held", "_pii_ends")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
