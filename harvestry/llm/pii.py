"""Personal data: generators of high recall, boosted trees over format and context, calibrated thresholds. SQL functions only.

Base patterns (``BASE``) give spans that always count. Generators (``LIKELY``) propose more, which may overlap: spelled-out addresses, numbers with
other separators or a wrong check digit. A candidate is described by a few small whole numbers: kind, digits, separators, the characters and
cue words around it, and by nothing that only tells it from a base span. It is known if it overlaps a base span of its kind or is valid once written
in the base form (at and dot as signs, no brackets, no separators, then the kind's own check; a phone needs its +, 0 or bracketed area code). One
aggregation over all candidates of all documents counts each description and how many of them are known; the trees are
boosted on those counts, of which there are at most ``MOST_KINDS`` whatever the corpus' size. A kind's threshold is calibrated as the score
that ``RECALL`` of its known ones reach. Candidates over it are added, unless they overlap a base span or a better candidate.

The patterns match what their plain forms match, but never go back: each starts only where a run of its characters starts, and takes whole runs.
Positions come from the lengths of matches and of the text between them, in code points.

Defined results: a null or empty text has no spans. Rows are judged one by one, so ids may be null and rows may repeat. Without known
candidates nothing is added. Other columns are ignored by ``find_spans`` and kept by ``redact``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
RECALL, LEAST_PRECISION, TREES, RATE, SHRINK, MOST_KINDS = 0.95, 0.05, 16, 0.4, 1.0, 40_000

# The four base patterns, without backtracking; the validity of a match is tested after it.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LIKELY = {
    "email": r"(?i)(?<![\w.%+-])[\w.%+-]++\s?(?:@|[\[({<]\s?at\s?[\])}>])\s?[\w-]++(?:(?:\.|\s?[\[({<]\s?dot\s?[\])}>]\s?)[\w-]++)++",
    "ip": r"(?<![\w.])[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?!\w)|(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])",
    "card": r"(?<![\w.])[0-9](?:[\x20._/-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,4}\)?){2,5}(?![0-9])|\([0-9]{3}\)\x20?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])",
}
CUES = {"email": "mail|contact|write|reach", "ip": "ip|addr|host|server|client", "card": "card|visa|master|amex|credit|debit|pay|konto|tarjeta|carte", "phone": "phone|tel|call|mobile|fax|cell|whatsapp"}
#: Descriptions of a candidate, and the largest value of each.
TRAITS = {"kind": 3, "digits": 7, "seps": 4, "before": 4, "after": 3, "cue": 1}


def _luhn(match: Column) -> Column:
    digits = F.translate(match, " -", "")
    n = F.length(digits)

    def step(total: Column, k: Column) -> Column:
        digit = F.substring(digits, n - k + 1, F.lit(1)).cast("int")
        return total + F.when(k % 2 == 1, digit).when(digit > 4, 2 * digit - 9).otherwise(2 * digit)

    return F.when(n.between(12, 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0).otherwise(False)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        short = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.forall(F.split(match, r"\."), lambda p: F.when(F.length(short(p)) <= 3, short(p).cast("int") <= 255).otherwise(False))
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        return F.length(F.translate(match, "+ ().-", "")).between(9, 15)
    return F.lit(True)


def _valid_form(kind: str, match: Column) -> Column:
    """Whether a likely match is valid once it is written as the base form of its kind."""
    dotted = F.regexp_replace(match, r"(?i)\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?", ".")
    if kind == "email":
        return F.regexp_replace(dotted, r"(?i)\s?(?:@|[\[({<]\s?at\s?[\])}>])\s?", "@").rlike(r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$")
    if kind == "ip":
        return F.when(match.contains(":"), True).otherwise(_valid("ip", dotted))
    if kind == "card":
        return _luhn(F.translate(match, " ._/-", ""))
    return match.rlike(r"^(?:\+|\(?0|\([0-9]{3}\))") & F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)


def _spans(matches: Column, between: Column) -> Column:
    """``start, end, match`` of each match, from the pieces of text around them."""
    def step(state: Column, k: Column) -> Column:
        start = state["at"] + F.length(between[k])
        end = start + F.length(matches[k])
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end"), matches[k].alias("match")))).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    found = F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), F.struct(F.lit(0).alias("at"), none.alias("spans")), step)["spans"]
    return F.when(F.size(matches) > 0, found).otherwise(none)


def _level(value: Column, *bounds: int) -> Column:
    out = F.lit(len(bounds))
    for k in range(len(bounds) - 1, -1, -1):
        out = F.when(value < bounds[k], k).otherwise(out)
    return out


def _traits(kind: str, text: Column, span: Column) -> list[Column]:
    match, before = span["match"], F.substring(text, F.greatest(span["start"] - 23, F.lit(1)), F.least(span["start"], F.lit(24)))
    prior, after = F.right(before, F.lit(1)), F.substring(text, span["end"] + 1, F.lit(1))
    bare = F.regexp_replace(match, "[^0-9A-Za-z]", "")
    digits = F.length(F.regexp_replace(bare, "[^0-9]", ""))
    return [
        F.lit(KINDS.index(kind)), _level(digits, 7, 9, 11, 12, 14, 16, 17), _level(F.length(match) - F.length(bare), 1, 2, 3, 4),
        F.when(prior.rlike(r"^\s?$"), 0).when(prior.rlike(r"[\"'(\[<{]"), 1).when(prior.rlike(r"\p{L}"), 2).when(prior.rlike("[=:+]"), 3).otherwise(4),
        F.when(after.rlike(r"^\s?$"), 0).when(after.rlike(r"[.,;:!?\"')\]]"), 1).when(after.rlike(r"\p{L}"), 3).otherwise(2),
        F.lower(before).rlike(CUES[kind]).cast("int"),
    ]


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _base_of(kind: str, spans: Column) -> Column:
    number = KINDS.index(kind)
    valid = F.filter(spans, lambda s: _valid(kind, s["match"]))
    return F.transform(valid, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))


def _likely_of(kind: str, spans: Column, base: Column, text: Column) -> Column:
    number = KINDS.index(kind)

    def described(s: Column) -> Column:
        known = F.exists(base, lambda b: _overlap(s, b) & (b["kind"] == number)) | _valid_form(kind, s["match"])
        return F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), known.alias("known"), F.array(*_traits(kind, text, s)).alias("traits"))

    return F.transform(spans, described)


def candidates(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``base`` spans (start, kind, end) and ``likely`` ones (also their traits and whether they are ``known``: base spans, or valid once normalised) of every row."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    guards = {"email": lambda t: t.rlike(r"@|(?i)[\[({<]\s?at\s?[\])}>]"), "ip": lambda t: t.rlike("[0-9A-Fa-f][.:\\[(]"), "card": lambda t: t.rlike("[0-9]"), "phone": lambda t: t.rlike("[0-9]")}
    patterns = {f"b_{k}": (p, k) for k, p in BASE.items()} | {f"l_{k}": (p, k) for k, p in LIKELY.items()}
    # Matches, the text between them, and spans are projections of their own, so that no pattern runs twice.
    df = docs.select(*keep, body.alias("_t"))
    empty = F.array().cast("array<string>")
    df = df.select("*", *(F.when(guards[k](F.col("_t")), F.regexp_extract_all("_t", F.lit(p), F.lit(0))).otherwise(empty).alias(f"_m_{n}") for n, (p, k) in patterns.items()))
    df = df.select("*", *(F.when(F.size(f"_m_{n}") > 0, F.split("_t", p, -1)).alias(f"_p_{n}") for n, (p, _) in patterns.items()))
    df = df.select(*keep, "_t", *(_spans(F.col(f"_m_{n}"), F.col(f"_p_{n}")).alias(n) for n in patterns))
    base = F.concat(*(_base_of(k, F.col(f"b_{k}")) for k in KINDS))
    df = df.select(*keep, "_t", *(f"l_{k}" for k in KINDS), F.sort_array(base).alias("base"))
    likely = (_likely_of(k, F.col(f"l_{k}"), F.col("base"), F.col("_t")) for k in KINDS)
    return df.select(*keep, "base", F.concat(*likely).alias("likely"))


@dataclass
class Model:
    """Trees of depth two: (trait, bound) at the top and below either side, and four leaf values; the least score by kind."""

    trees: list[tuple]
    least: dict[int, float]

    def score(self, traits: Column) -> Column:
        total = F.lit(0.0)
        for (a, s), ((b, t), (c, u)), leaf in self.trees:
            total = total + F.when(traits[a] <= s, F.when(traits[b] <= t, leaf[0]).otherwise(leaf[1])).otherwise(F.when(traits[c] <= u, leaf[2]).otherwise(leaf[3]))
        return total


def _best_cut(rows, grads, own, tops) -> tuple[tuple[int, int], float]:
    """The cut of the rows ``own`` with the largest gain, from one histogram per trait."""
    best, most = (0, tops[0]), 0.0
    whole_g, whole_h = sum(grads[i][0] for i in own), sum(grads[i][1] for i in own)
    for trait, top in enumerate(tops):
        bins = [[0.0, 0.0] for _ in range(top + 1)]
        for i in own:
            cell = bins[rows[i][0][trait]]
            cell[0] += grads[i][0]
            cell[1] += grads[i][1]
        g = h = 0.0
        for bound in range(top):
            g, h = g + bins[bound][0], h + bins[bound][1]
            gain = g * g / (h + SHRINK) + (whole_g - g) ** 2 / (whole_h - h + SHRINK) - whole_g * whole_g / (whole_h + SHRINK)
            if gain > most + 1e-9:
                best, most = (trait, bound), gain
    return best, most


def learn(found: DataFrame, trees: int = TREES) -> Model:
    """Boost trees on how often each description is known, and calibrate the thresholds on the same counts."""
    each = found.select(F.explode("likely").alias("c")).groupBy("c.traits").agg(F.count("*").alias("n"), F.sum(F.col("c.known").cast("long")).alias("known"))
    rows = sorted((tuple(r["traits"]), r["n"], r["known"]) for r in each.orderBy(F.desc("n")).limit(MOST_KINDS).collect())  # all of them: the traits allow fewer
    if not rows or not any(k for _, _, k in rows):
        return Model([], {})
    tops, scores, grown = list(TRAITS.values()), [0.0] * len(rows), []
    for _ in range(trees):
        grads = []
        for (_, n, known), s in zip(rows, scores):
            p = 1 / (1 + math.exp(-s))
            grads.append((known - n * p, n * p * (1 - p)))
        everyone = range(len(rows))
        top, _ = _best_cut(rows, grads, everyone, tops)
        sides = [[i for i in everyone if rows[i][0][top[0]] <= top[1]], [i for i in everyone if rows[i][0][top[0]] > top[1]]]
        cuts = [_best_cut(rows, grads, side, tops)[0] for side in sides]
        leaves = []
        for side, (trait, bound) in zip(sides, cuts):
            for part in ([i for i in side if rows[i][0][trait] <= bound], [i for i in side if rows[i][0][trait] > bound]):
                value = RATE * sum(grads[i][0] for i in part) / (sum(grads[i][1] for i in part) + SHRINK)
                leaves.append(value)
                for i in part:
                    scores[i] += value
        grown.append((top, tuple(cuts), tuple(leaves)))
    least = {}
    for kind in range(len(KINDS)):
        own = sorted(((s, n, k) for (t, n, k), s in zip(rows, scores) if t[0] == kind), reverse=True)
        wanted, reached, taken = RECALL * sum(k for *_, k in own), 0, 0
        for s, n, k in own:
            reached, taken = reached + k, taken + n
            if reached >= wanted:
                if reached and reached >= LEAST_PRECISION * taken:
                    least[kind] = s - 1e-9
                break
    return Model(grown, least)


def find_spans(found: DataFrame, model: Model) -> DataFrame:
    """``found`` with ``spans``: base spans and added ones as (start, kind, end), sorted."""
    def passes(c: Column) -> Column:
        ok = F.lit(False)
        for kind, least in model.least.items():
            ok = ok | ((c["kind"] == kind) & (model.score(c["traits"]) >= least))
        return ok

    free = F.filter("likely", lambda c: ~F.exists("base", lambda b: _overlap(b, c)))
    chosen = found.withColumn("_free", free).withColumn("_over", F.filter("_free", passes)).withColumn(
        "_ranked", F.transform("_over", lambda c: F.struct(model.score(c["traits"]).alias("score"), (-c["start"]).alias("early"), (-c["kind"]).alias("first"), c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))
    better = lambda c, o: _overlap(c, o) & (F.struct(o["score"], o["early"], o["first"]) > F.struct(c["score"], c["early"], c["first"]))
    best = F.filter("_ranked", lambda c: ~F.exists("_ranked", lambda o: better(c, o)))
    added = F.transform(best, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return chosen.withColumn("spans", F.sort_array(F.concat("base", added))).drop("_free", "_over", "_ranked")


def of_kind(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.filter(spans, lambda s: s["kind"] == number)


def shown(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def spans_of(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, base, spans``. Candidates are made once and kept in the shared folder."""
    found = stored(candidates(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "candidates")
    return find_spans(found, learn(found)).select("doc_id", "base", "spans")


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with each span of ``text`` replaced by its kind in brackets; overlapping spans become one, named by the first."""
    names = docs.columns
    model = learn(stored(candidates(docs.select("text"), keep=()), "candidates"))
    held = docs.select(F.struct(*names).alias("_row"), F.col("text").alias("text"))
    spanned = find_spans(candidates(held, keep=("_row",)), model).withColumn("text", F.col("_row")["text"].cast("string"))
    # Runs of overlapping spans, as (start, kind, end).
    merge = lambda done, s: F.when((F.size(done) > 0) & (s["start"] < F.element_at(done, -1)["end"]), F.concat(
        F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.element_at(done, -1)["kind"].alias("kind"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))))).otherwise(
        F.concat(done, F.array(s)))
    runs = spanned.withColumn("_runs", F.aggregate("spans", F.array().cast("array<struct<start:int,kind:int,end:int>>"), merge))
    labels = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    part = lambda s, k: F.concat(F.substring(F.col("text"), F.coalesce(F.get("_runs", k - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get("_runs", k - 1)["end"], F.lit(0))), labels[s["kind"]])
    tail = F.substring(F.col("text"), F.element_at("_runs", -1)["end"] + 1, F.length("text"))
    clean = F.when(F.size("_runs") > 0, F.concat(F.array_join(F.transform("_runs", part), ""), tail)).otherwise(F.col("text"))
    return runs.withColumn("_clean", clean).select(*(F.col("_clean").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in names))
