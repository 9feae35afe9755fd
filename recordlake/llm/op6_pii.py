"""Operator 6, personal data: base patterns and bootstrapped contextual extraction.

DataFrame functions only. Base entities (email, ip, card, phone) come from regular
expressions, leftmost and non-overlapping for each kind, then checked. They seed the
contextual part: the words left and right of an entity are its lexical patterns. All
identifier-like tokens (with digits) of the corpus are instances, linked to the patterns
they stand in. Spark scores this graph iteratively: a pattern's confidence is the mean
weight of its instances, shrunk by its support; an instance that is no seed has the
noisy-or of its patterns' confidences as weight. Tokens that are no base entity and whose
weight reaches the bar through patterns that seeds support are found as kind ``id``.

Positions are code points, end exclusive. They come from the lengths of the pieces
between matches, summed over one document's matches.

The expressions below find the same matches as the plain ones, without their quadratic
time on long runs: a match can only start where its run starts or right after the last
match, and possessive loops don't give back what never helps.

Defined cases: a null text is empty; a text without spans has zero counts, the digest of
the empty string and an empty list; repeated rows give equal rows; an empty table gives
no rows; other columns are ignored. Texts are whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.llm.common import anchored, col, positioned, stage

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "id"
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # a token with a digit
    "token": r"(?<!\S)[^\s0-9]*+[0-9]\S*+",
}
#: Characters on either side in which the words of a context are looked for.
WINDOW = 64
ROUNDS = 3
MIN_SEEDS = 3      # distinct seed instances that a pattern needs
SHRINK = 1.0       # added to a pattern's number of instances
CONFIDENCE = 0.8


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def is_valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return (F.when(kind == "ip", match.rlike(rf"^{part}(?:\.{part}){{3}}$"))
            .when(kind == "card", F.when(n.between(16, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(8, 15)).otherwise(True))


def matches(docs: DataFrame, text: str = "text") -> DataFrame:
    """fh, row, kind, match, start, stop, left, right: every match of every pattern, with
    the text around it up to the next match of its kind, at most ``WINDOW`` characters."""
    src = positioned(docs, text=F.coalesce(col(text), F.lit("")))
    t = F.col("text")
    digit = t.rlike("[0-9]")
    may = {"email": F.contains(t, F.lit("@")), "phone": F.contains(t, F.lit("+")) & digit}
    found = F.array(*[
        F.struct(F.lit(k).alias("kind"),
                 F.when(may.get(k, digit), F.split(t, p, -1)).alias("gaps"),
                 F.when(may.get(k, digit), F.regexp_extract_all(t, F.lit(p), F.lit(0))).alias("found"))
        for k, p in PATTERNS.items()])
    kinds = src.select("fh", "row", F.explode(found).alias("k")).where(F.size("k.found") > 0)
    one = F.transform(F.col("k.found"), lambda m, i: F.struct(
        m.alias("match"), F.length(F.col("k.gaps")[i]).alias("gap"),
        F.substring(F.col("k.gaps")[i], -WINDOW, WINDOW).alias("left"),
        F.substring(F.col("k.gaps")[i + 1], 1, WINDOW).alias("right")))
    rows = kinds.select("fh", "row", "k.kind", F.posexplode(one).alias("i", "m"))
    size = F.length("m.match")
    order = Window.partitionBy("fh", "row", "kind").orderBy("i")  # one document's matches
    stop = F.sum(F.col("m.gap") + size).over(order)
    return rows.select("fh", "row", "kind", "m.match", (stop - size).alias("start"), stop.alias("stop"), "m.left", "m.right")


def _clean(c: Column) -> Column:
    """A word of a context: lower case, digits alike."""
    return F.regexp_replace(F.lower(c), "[0-9]+", "0")


def occurrences(found: DataFrame) -> DataFrame:
    """fh, row, start, stop, instance, seed, pattern: instances in their patterns."""
    value = r"([A-Za-z0-9][A-Za-z0-9._/+-]*[A-Za-z0-9])[^A-Za-z0-9]*$"
    m = F.col("match")
    base = found.where((F.col("kind") != "token") & is_valid(F.col("kind"), m)).select(
        "fh", "row", "start", "stop", F.lower(m).alias("instance"), F.lit(True).alias("seed"),
        F.lit("").alias("lead"), "left", "right")
    inner = F.regexp_extract(m, value, 1)
    at = F.length(m) - F.length(F.regexp_extract(m, value, 0))
    digits = F.length(F.regexp_replace(inner, "[^0-9]", ""))
    token = found.where(F.col("kind") == "token").select(
        "fh", "row", (F.col("start") + at).alias("start"), (F.col("start") + at + F.length(inner)).alias("stop"),
        F.lower(inner).alias("instance"), F.lit(False).alias("seed"), F.substring(m, F.lit(1), at).alias("lead"),
        F.col("left"), F.col("right"), digits.alias("digits"))
    token = token.where((F.length("instance") >= 6) & (F.col("digits") >= 4)).drop("digits")
    # a token that overlaps a base entity is that entity
    spans = base.select("fh", "row", F.col("start").alias("s"), F.col("stop").alias("e"))
    token = token.join(spans, (token.fh == spans.fh) & (token.row == spans.row)
                       & (F.col("start") < F.col("e")) & (F.col("s") < F.col("stop")), "left_anti")
    both = base.unionByName(token)
    word = r"(\S*\w\S*(?:\s+[^\w\s]+)*)\s*$"
    before = F.when(F.col("lead").rlike("[A-Za-z]"), F.col("lead")).otherwise(
        F.regexp_extract(F.concat("left", "lead"), word, 1))
    after = F.regexp_extract("right", r"^\s*(\S*\w)", 1)
    return both.select(
        "fh", "row", "start", "stop", "instance", "seed",
        F.explode(F.array(F.struct(F.lit("left").alias("side"), _clean(before).alias("words")),
                          F.struct(F.lit("right").alias("side"), _clean(after).alias("words")))).alias("pattern")
    ).where("pattern.words != ''")


def score(edges: DataFrame) -> DataFrame:
    """instance, weight: of the instances that are no seeds. ``edges``: distinct (instance,
    seed, pattern)."""
    seeds = edges.groupBy("pattern").agg(F.count(F.when(F.col("seed"), 1)).alias("seeds"), F.count("*").alias("n"))
    base = stage(seeds.where(F.col("seeds") >= MIN_SEEDS), "patterns")
    edges = stage(edges.join(base, "pattern"), "edges")
    weight = None
    for _ in range(ROUNDS):
        w = (edges.withColumn("weight", F.lit(0.0)) if weight is None
             else edges.join(weight, "instance", "left").fillna(0.0, ["weight"]))
        sure = F.sum(F.when(F.col("seed"), F.lit(1.0)).otherwise(F.col("weight"))) / (F.max("n") + SHRINK)
        confidence = stage(w.groupBy("pattern").agg(F.least(sure, F.lit(0.999)).alias("confidence")), "confidence")
        weight = stage(edges.where("not seed").join(confidence, "pattern").groupBy("instance").agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("weight"),
            F.max("confidence").alias("best")), "weight")
    return weight


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_id, base_sha256, spans, and ``found``
    (array of kind, start, stop): one row per row of ``docs``."""
    docs = anchored(docs)
    found = stage(matches(docs, text), "matches")
    base = found.where((F.col("kind") != "token") & is_valid(F.col("kind"), F.col("match"))).select("fh", "row", "kind", "start", "stop")
    seen = stage(occurrences(found), "occurrences")
    weight = score(seen.select("instance", "seed", "pattern").groupBy("instance", "pattern").agg(F.max("seed").alias("seed")))
    sure = weight.where((F.col("weight") >= CONFIDENCE) & (F.col("best") >= CONFIDENCE)).select("instance")
    more = (seen.where("not seed").join(stage(sure, "sure"), "instance", "left_semi")
            .select("fh", "row", F.lit(CONTEXT).alias("kind"), "start", "stop").distinct())
    kinds = F.array(*[F.lit(k) for k in (*KINDS, CONTEXT)])
    spans = base.unionByName(more).withColumn("o", F.array_position(kinds, F.col("kind")))
    one = spans.groupBy("fh", "row").agg(
        F.sort_array(F.collect_list(F.struct("o", "start", "stop", "kind"))).alias("found"),
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in (*KINDS, CONTEXT)])
    rows = positioned(docs, doc_id=col(doc_id)).join(stage(one, "found"), ["fh", "row"], "left")
    rows = rows.withColumn("found", F.coalesce("found", F.expr("cast(array() as array<struct<o:bigint,start:bigint,stop:bigint,kind:string>>)")))

    def text_of(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    return rows.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in (*KINDS, CONTEXT)],
        F.sha2(text_of(F.filter("found", lambda s: s["kind"] != CONTEXT)), 256).alias("base_sha256"),
        text_of(F.col("found")).alias("spans"),
        F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))).alias("found"))
