"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose spans. Labelers vote on each: the pattern's own check, a gazetteer of prefixes and
domain ends, words before the span, and the characters around it. Expectation-maximisation finds how
reliable each labeler is from the counts of vote patterns, whose number is bounded. Its posteriors
train a logistic classifier on the span's shape and surroundings. Spans that pass their check always
stay. Proposed besides are spans that fail it, phone numbers with other digits behind them (cut back to
the number), and addresses written with (at) and (dot); they are added when the classifier is sure.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlake.scratch import scratch_path

KINDS = ("email", "ip", "card", "phone")

# Fixed values. The quantifiers keep what they took where no other cut can match, and a match begins
# at the start of its run of characters or where the last match ended, so no run is tried again from
# each of its characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Spans that the patterns miss: a kind, its pattern, and what a text must hold for it.
SPELLED = {
    "spelled": (
        "email",
        r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
        r"(?i)[(\[]at[)\]]",
    ),
}
#: The number at the beginning of a match that goes on with other digits after a space.
CUT_BACK = r"^\+(?:[^0-9]*[0-9]){9,15}(?=\x20)"
#: What a text must hold for the pattern to match at all; cheap to look for.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
GAZETTEER = {
    "email": r"(?i)(?:\.|[(\[]dot[)\]] ?)(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us|ch|at|nl)$",
    "ip": r"^(?:[1-9][0-9]?|1[0-9][0-9]|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^\+(?:1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
}
CONTEXT = {
    "email": r"(?i)(?:mail|contact|write|reply|kontakt|courriel|correo)\W*(?:\w+\W+){0,2}$",
    "ip": r"(?i)(?:\bip\b|host|server|address|client|login|addr)\W*(?:\w+\W+){0,2}$",
    "card": r"(?i)(?:card|visa|master|amex|credit|pay|karte|carte|tarjeta)\W*(?:\w+\W+){0,2}$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|cell|fon|telefon|téléphone|teléfono)\W*(?:\w+\W+){0,2}$",
}
AGAINST = r"(?i)(?:version|build|order|isbn|serial|invoice|id|no)\W*$"
LABELERS = 4
FEATURES = 6
#: How a true span fares with its check, as known beforehand; it weighs as much as all spans found. The
#: first labeler is the check. Without it, numbers that look alike but fail would vouch for each other.
CHECKED = {1: 0.94, 0: 0.03, -1: 0.03}
SURE = 0.9
ROUNDS = 50


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit fits: from the right, every second digit is doubled."""
    at = F.sequence(F.lit(1), F.length(digits))
    d = F.transform(at, lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int"))
    value = F.transform(d, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def _check(kind: str, m: Column) -> Column:
    if kind == "ip":
        # More than 9 digits after leading zeros are above 255 and must not overflow.
        parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _proposed(kind: str, m: Column) -> Column:
    """Matches worth a vote though they fail their check."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.length(p) <= 3)
    if kind == "card":
        return F.length(_digits(m)).between(12, 19)
    if kind == "phone":
        return F.length(_digits(m)) >= 7
    return F.lit(True)


def _before(sizes: Column) -> Column:
    """Sums of all earlier entries. Blocks of 64 keep the work per entry small in long arrays."""
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    block = 64
    n = F.size(sizes)
    blocks = F.transform(F.sequence(F.lit(0), F.floor(n / block).cast("int")), lambda b: total(F.slice(sizes, b * block + 1, block)))
    starts = F.transform(blocks, lambda _, b: total(F.slice(blocks, F.lit(1), b)))
    return F.transform(sizes, lambda _, i: F.element_at(starts, F.floor(i / block).cast("int") + 1) + total(F.slice(sizes, F.floor(i / block).cast("int") * block + 1, i % block)))


def _columns_once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """New columns behind a generator, so that later uses read them and do not compute them again."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _stretches(kind: str) -> Column:
    """Length of each match with the text before it, since the match before."""
    return F.transform(f"{kind}_m", lambda m, i: F.col(f"{kind}_g")[i]["n"] + F.length(m))


def _spans(no: int, name: str, check: bool = True) -> Column:
    """The matches under ``name`` as spans of kind ``no``; without ``check`` none is a base span."""
    g = F.col(f"{name}_g")
    kind = KINDS[no]

    def span(m: Column, i: Column) -> Column:
        begin = F.col(f"{name}_s")[i] + g[i]["n"]
        base = _check(kind, m) if check else F.lit(False)
        own = m
        if kind == "phone":
            cut = F.regexp_extract(m, CUT_BACK, 0)
            own = F.when(~base & (cut != ""), cut).otherwise(m)
        # Behind a match that was cut back its own rest follows.
        head = F.when(F.length(own) < F.length(m), F.lit(" ")).otherwise(F.element_at(g, i + 2)["head"])
        return F.struct(begin.alias("start"), F.lit(no).alias("kind"), (begin + F.length(own)).alias("end"), own.alias("m"), g[i]["tail"].alias("tail"), head.alias("head"), base.alias("base"))

    spans = F.transform(f"{name}_m", span)
    return F.filter(spans, lambda s: s["base"] | _proposed(kind, s["m"])) if check else spans


def proposals(docs: DataFrame) -> DataFrame:
    """doc_id and its proposed spans: kind, start, end, base, votes and features."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = {}
    searched = {k: (PATTERNS[k], F.contains("text", F.lit("@")) if k == "email" else F.col("text").rlike(NEEDS[k])) for k in KINDS}
    searched |= {name: (pattern, F.col("text").rlike(need)) for name, (_, pattern, need) in SPELLED.items()}
    for name, (pattern, has) in searched.items():
        found[f"{name}_m"] = F.when(has, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
        gaps = F.transform(F.split("text", pattern, -1), lambda g: F.struct(F.length(g).cast("long").alias("n"), F.right(g, F.lit(40)).alias("tail"), F.substring(g, 1, 1).alias("head")))
        found[f"{name}_g"] = F.when(has, gaps).otherwise(F.expr("cast(array() as array<struct<n:long,tail:string,head:string>>)"))
    df = _columns_once(df, ["doc_id"], **found)
    start = {f"{k}_s": _before(_stretches(k)) for k in searched}
    df = _columns_once(df, ["doc_id", *found], **start)
    spans = [_spans(no, kind) for no, kind in enumerate(KINDS)]
    spans += [_spans(KINDS.index(kind), name, False) for name, (kind, *_) in SPELLED.items()]
    df = _columns_once(df, ["doc_id"], spans=F.concat(*spans))
    return df.select("doc_id", F.transform("spans", _judged).alias("spans"))


def _by_kind(kind: Column, choice) -> Column:
    out = F.when(kind == 0, choice(KINDS[0]))
    for i, k in enumerate(KINDS[1:], 1):
        out = out.when(kind == i, choice(k))
    return out


def _judged(s: Column) -> Column:
    """A proposed span with its votes (1 for, -1 against, 0 none) and its features."""
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    plain = F.regexp_replace(s["m"], "[ ()-]", "")
    # The check has no say on an address spelled out, and none against a number that was cut back.
    fits = s["base"] | _by_kind(s["kind"], lambda k: _check(k, s["m"]) if k == "phone" else F.lit(False))
    own = F.when(fits, yes).when((s["kind"] == 0), none).otherwise(no)
    known = _by_kind(s["kind"], lambda k: F.when((s["m"] if k == "email" else plain).rlike(GAZETTEER[k]), yes).otherwise(no))
    near = F.when(s["tail"].rlike(AGAINST), no).when(_by_kind(s["kind"], lambda k: s["tail"].rlike(CONTEXT[k])), yes).otherwise(none)
    alone = (F.right(s["tail"], F.lit(1)).rlike(r"^$|[\s(<\[\"':;,]")) & s["head"].rlike(r"^$|[\s)>\]\"':;,.!?]")
    digits = F.length(_digits(s["m"]))
    features = F.array(
        F.least(digits, F.lit(20)).cast("int"),
        F.least(F.length(s["m"]) - digits, F.lit(9)).cast("int"),
        F.when(s["head"].rlike("[A-Za-z0-9]"), 2).when(s["head"].rlike(r"^$|\s"), 0).otherwise(1),
        F.when(F.right(s["tail"], F.lit(1)).rlike("[A-Za-z0-9]"), 2).when(F.right(s["tail"], F.lit(1)).rlike(r"^$|\s"), 0).otherwise(1),
        near,
        known,
    )
    return F.struct(s["start"], s["kind"], s["end"], s["base"], F.array(own, known, near, F.when(alone, yes).otherwise(no)).alias("votes"), features.alias("features"))


def reliabilities(counts: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[dict[int, tuple[float, float]]], dict]:
    """Share of true spans, each labeler's vote probabilities (for a false, a true span), posteriors.

    ``counts`` has each vote pattern once. Starts from the majority and takes one vote per labeler
    as independent given the truth.
    """
    post = {v: min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for v, _ in counts}
    share, table = 0.5, []
    for _ in range(ROUNDS):
        total = sum(n for _, n in counts)
        share = (sum(n * post[v] for v, n in counts) + 1) / (total + 2)
        table = []
        for j in range(LABELERS):
            mass = {x: [0.5, 0.5 + (total * CHECKED[x] if j == 0 else 0)] for x in (-1, 0, 1)}
            for v, n in counts:
                mass[v[j]][1] += n * post[v]
                mass[v[j]][0] += n * (1 - post[v])
            sums = [sum(m[y] for m in mass.values()) for y in (0, 1)]
            table.append({x: (m[0] / sums[0], m[1] / sums[1]) for x, m in mass.items()})
        for v, _ in counts:
            odds = math.log(share / (1 - share)) + sum(math.log(table[j][x][1] / table[j][x][0]) for j, x in enumerate(v))
            post[v] = 1 / (1 + math.exp(-max(-30, min(30, odds))))
    return share, table, post


def fit_classifier(rows: list[tuple[tuple[int, ...], float, int]], steps: int = 300, rate: float = 0.5) -> dict:
    """Logistic weights by (place, value) of the features, from soft labels and counts."""
    weights: dict = defaultdict(float)
    total = max(1, sum(n for *_, n in rows))
    for _ in range(steps):
        slope: dict = defaultdict(float)
        for f, y, n in rows:
            keys = [("bias", 0), *enumerate(f)]
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(weights[k] for k in keys)))))
            for k in keys:
                slope[k] += n * (p - y)
        for k, g in slope.items():
            weights[k] -= rate * (g / total + 1e-3 * weights[k])
    return dict(weights)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and spans (start, kind, end, base, score), sorted by start and kind, for every row.

    Offsets are code points, ends exclusive. Null and empty texts have no spans. Rows that repeat id
    and text each have a row; other columns are ignored. The driver gets counts of vote and feature
    patterns only, a number bounded by their values. Whole texts are searched, in one scan.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "pii")
    proposals(docs).write.parquet(path)
    found = spark.read.parquet(path)
    patterns = found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.features").count().collect()
    weights = {}
    for no in range(len(KINDS)):
        own = [(tuple(r["votes"]), tuple(r["features"]), r["count"]) for r in patterns if r["kind"] == no]
        by_votes: dict = defaultdict(int)
        for v, _, n in own:
            by_votes[v] += n
        if own:
            *_, post = reliabilities(sorted(by_votes.items()))
            weights[no] = fit_classifier(sorted((f, post[v], n) for v, f, n in own))
    scored = F.transform("spans", lambda s: F.struct(s["start"], s["kind"], s["end"], s["base"], _score(s, weights).alias("score")))
    spans = found.select("doc_id", scored.alias("spans"))
    base = F.filter("spans", lambda s: s["base"])
    more = F.filter("spans", lambda s: ~s["base"] & (s["score"] >= SURE))
    split = spans.select("doc_id", base.alias("sure"), more.alias("more"))
    # An added span may not overlap one that passed its check.
    free = F.filter("more", lambda s: ~F.exists("sure", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return split.select("doc_id", F.array_sort(F.concat("sure", free)).alias("spans"))


def _score(span: Column, weights: dict[int, dict]) -> Column:
    out = F.lit(0.0)
    for kind, own in weights.items():
        total = F.lit(own.get(("bias", 0), 0.0))
        for place in range(FEATURES):
            known = {v: w for (p, v), w in own.items() if p == place}
            part = F.lit(0.0)
            for value, w in known.items():
                part = F.when(span["features"][place] == value, F.lit(w)).otherwise(part)
            total = total + part
        out = F.when(span["kind"] == kind, 1 / (1 + F.exp(-total))).otherwise(out)
    return out


def summary(found: DataFrame) -> DataFrame:
    """Numbers of base spans by kind, the digest of their list, and the list of all spans."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    own = found.withColumn("own", F.filter("spans", lambda s: s["base"]))
    of = lambda i: F.size(F.filter("own", lambda s: s["kind"] == i)).cast("long")
    count = [of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return own.select("doc_id", *count, F.sha2(line(F.col("own")), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
