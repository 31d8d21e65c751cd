"""Personal data by bootstrapped contextual extraction, in DataFrame expressions only.

Seeds are addresses, IP numbers, cards and phone numbers with a fixed form. Every token with a digit or an at sign is an instance, and the
words around it give lexical patterns of several widths: the word before it, the two words before it, and the word on either side. Only words with
two letters or more are context; marks and numbers are not. Distinct (pattern, instance) pairs
are a graph. Scores travel over it for some rounds: a pattern is as good as the mean score of its instances, an
instance as good as its accepted patterns together. In the end, patterns above the threshold mark the instances in their
place that no fixed form knows.

Positions come from cutting the text at the matches: the lengths of what lies between and of the matches add up to them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.tables import stored

# The base forms. Possessive loops and the anchor (end of the last match, or no such character before) give the
# same matches as plain loops, without trying every start inside a long run.
LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# On a text in which each separator after a separator is replaced, a run of digits with single separators.
CARD = r"[0-9][0-9\x20-]*[0-9]"
INSTANCE = rf"{PHONE}|(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
KINDS = ("email", "ip", "card", "phone")
SPAN = "struct<kind:string,start:long,end:long>"
CHUNK = 512


@dataclass(frozen=True)
class Bootstrap:
    """Rounds of scoring, distinct good instances a pattern needs, its least score, and digits of a new identifier."""
    rounds: int = 3
    support: int = 3
    confidence: float = 0.7
    digits: int = 4


def _sums(numbers: str) -> str:
    """SQL for the running sums of an array column."""
    return (f"aggregate({numbers}, named_struct('t', 0L, 'l', cast(array() as array<bigint>)), "
            "(a, v) -> named_struct('t', a.t + v, 'l', concat(a.l, array(a.t + v))), a -> a.l)")


def located(rows: DataFrame, text: str, pattern: str, name: str, when: Column) -> DataFrame:
    """Adds ``name``, an array of (start, end, value) of the matches in column ``text``, and ``name``_gaps, what lies between them."""
    none = F.array().cast("array<string>")
    rows = rows.withColumn(f"{name}_found", F.when(when, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    some = F.size(f"{name}_found") > 0
    rows = rows.withColumn(f"{name}_gaps", F.when(some, F.split(text, pattern, -1)).otherwise(none))
    rows = rows.withColumn(f"{name}_steps", F.expr(f"transform({name}_found, (m, i) -> bigint(length({name}_gaps[i]) + if(i > 0, length({name}_found[i - 1]), 0)))"))
    # Running sums within chunks, and over the chunks, so that a text with very many matches does not take quadratic time.
    rows = rows.withColumn(f"{name}_chunks", F.expr(
        f"transform(sequence(0, greatest(0, size({name}_steps) - 1) div {CHUNK}), c -> slice({name}_steps, int(c * {CHUNK} + 1), {CHUNK}))"))
    rows = rows.withColumn(f"{name}_totals", F.expr(_sums(f"transform({name}_chunks, p -> aggregate(p, 0L, (t, v) -> t + v))")))
    # The totals are named twice so that the optimizer keeps them as a column and does not repeat them for each chunk.
    rows = rows.withColumn(f"{name}_starts", F.expr(
        f"if({name}_totals is null, null, flatten(transform({name}_chunks, (p, i) -> transform({_sums('p')}, v -> v + if(i = 0, 0L, {name}_totals[i - 1])))))"))
    rows = rows.withColumn(name, F.expr(f"transform({name}_found, (m, i) -> named_struct('start', {name}_starts[i], 'end', {name}_starts[i] + length(m), 'value', m))"))
    return rows.drop(*(f"{name}_{part}" for part in ("found", "steps", "chunks", "totals", "starts")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, F.lit("[^0-9]"), F.lit(""))


def _passes_luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda total, digit: total + digit) % 10 == 0


def _is_card(value: Column) -> Column:
    digits = _digits(value)
    return F.when(F.length(digits).between(16, 19), _passes_luhn(digits)).otherwise(False)


def _is_ip(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: F.when(F.length(p) > 3, False).otherwise(F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))


def _spans(matches: Column, kind: str) -> Column:
    return F.transform(matches, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, row (a key of id and text), base (spans of the four kinds) and instances with their contexts, a row per document."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"), 256))
    digit, at = F.regexp_like("text", F.lit("[0-9]")), F.instr("text", "@") > 0
    rows = rows.withColumn("digit", digit).withColumn("at", at)
    single = F.when(F.col("digit"), F.regexp_replace("text", F.lit(r"(?<=[\x20-])[\x20-]"), F.lit("x"))).otherwise("")
    rows = rows.withColumn("single", single)
    rows = located(rows, "text", EMAIL, "email", F.col("at"))
    rows = located(rows, "text", IP, "ip", F.col("digit"))
    rows = located(rows, "single", CARD, "card", F.col("digit"))
    rows = located(rows, "text", PHONE, "phone", F.col("digit") & (F.instr("text", "+") > 0))
    rows = located(rows, "text", INSTANCE, "instance", F.col("digit") | F.col("at"))
    keep = {"email": lambda m: F.lit(True), "ip": lambda m: _is_ip(m["value"]), "card": lambda m: _is_card(m["value"]),
            "phone": lambda m: F.length(_digits(m["value"])).between(8, 15)}
    base = F.concat(*(_spans(F.filter(kind, keep[kind]), kind) for kind in KINDS))
    plain = lambda text: F.translate(F.lower(text), "\n\t\r\f", "    ")
    instances = F.transform("instance", lambda m, i: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"),
        F.rtrim(plain(F.substring(F.element_at("instance_gaps", i + 1), -80, 80))).alias("before"),
        F.ltrim(plain(F.substring(F.element_at("instance_gaps", i + 2), 1, 80))).alias("after")))
    return rows.select("doc_id", "row", base.alias("base"), instances.alias("instances"))


def _occurrences(rows: DataFrame, rule: Bootstrap) -> DataFrame:
    """(row, start, end, instance, seed, new, pattern): every instance with each of its patterns; identical rows once."""
    each = rows.select("row", F.explode("instances").alias("i"), "base").select("row", "i.*", "base")
    value = F.regexp_replace("value", F.lit(r"[.,;:!?)\]}>\"']+$"), F.lit(""))
    each = each.withColumn("value", value).where("value != ''")
    end = F.col("start") + F.length("value")
    # A base span in, around or across an instance makes it a seed.
    seed = F.exists("base", lambda s: (s["start"] < end) & (s["end"] > F.col("start")))
    left, right = F.substring_index("before", " ", -1), F.substring_index("after", " ", 1)
    pair = F.substring_index("before", " ", -2)
    worded = lambda text: F.regexp_like(text, F.lit(r"\p{L}.*\p{L}"))
    one = F.when(worded(left), F.concat(F.lit("before "), left))
    two = F.when(worded(left) & (F.instr("before", " ") > 0) & worded(F.substring_index(pair, " ", 1)), F.concat(F.lit("before "), pair))
    around = F.when(worded(left) & worded(right), F.concat(F.lit("around "), left, F.lit(" _ "), right))
    patterns = F.array_compact(F.array(one, two, around))
    new = F.length(_digits(F.col("value"))) >= rule.digits
    return each.select("row", "start", end.alias("end"), F.lower("value").alias("instance"), seed.alias("seed"), new.alias("new"),
                       F.explode(patterns).alias("pattern")).dropDuplicates(["row", "start", "pattern"])


def good_patterns(occurrences: DataFrame, rule: Bootstrap) -> DataFrame:
    """(pattern, confidence) of the patterns that the seeds lead to."""
    edges = stored(occurrences.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    seeds = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("known"))
    scores = seeds.withColumnRenamed("known", "score")
    for _ in range(rule.rounds):
        judged = edges.join(scores, "instance").groupBy("pattern").agg(
            (F.sum("score") / F.count(F.lit(1))).alias("confidence"), F.sum("score").alias("support"))
        accepted = stored(judged.where((F.col("support") >= rule.support) & (F.col("confidence") >= rule.confidence)).select("pattern", "confidence"), "patterns")
        # One minus the chance that all accepted patterns of an instance are wrong.
        found = edges.join(accepted, "pattern").groupBy("instance").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))).alias("found"))
        scores = stored(seeds.join(found, "instance", "left").select(
            "instance", F.greatest("known", F.coalesce("found", F.lit(0.0))).alias("score")), "scores")
    return accepted


def rediscovery(docs: DataFrame, rule: Bootstrap = Bootstrap(), hide: int = 5) -> DataFrame:
    """How well contexts alone find identifiers: one of ``hide`` seeds, by hash, is hidden from the scoring.

    One row: hidden (distinct hidden identifiers that have a context), found (those that accepted patterns lead to), marked (all identifiers they lead
    to) and known (marked ones that are seeds, hidden or not). found / hidden is the recall, known / marked a lower bound of the precision.
    """
    occurrences = stored(_occurrences(stored(base_spans(docs), "instances"), rule), "occurrences")
    each = occurrences.withColumn("hidden", F.col("seed") & (F.pmod(F.xxhash64("instance"), F.lit(hide)) == 0))
    accepted = good_patterns(each.withColumn("seed", F.col("seed") & ~F.col("hidden")), rule)
    marked = each.join(accepted.select("pattern", F.lit(True).alias("accepted")), "pattern", "left").groupBy("instance").agg(
        F.max("seed").alias("seed"), F.max("hidden").alias("hidden"), F.max(F.coalesce("accepted", F.lit(False))).alias("marked"))
    return marked.agg(F.count_if("hidden").alias("hidden"), F.count_if(F.col("hidden") & F.col("marked")).alias("found"),
                      F.count_if("marked").alias("marked"), F.count_if(F.col("marked") & F.col("seed")).alias("known"))


def find_personal_data(docs: DataFrame, rule: Bootstrap = Bootstrap()) -> DataFrame:
    """(doc_id, spans) of every row of ``docs(doc_id, text)``: base kinds in order, each by start, then kind ``context`` by start.

    Spans are code points, end exclusive. Per base kind the matches are leftmost and do not overlap; those that fail the kind's check are
    dropped and not tried again. ``context`` spans are new identifiers and touch no base span. A null text is empty and
    has no spans. Repeated rows stay, and identical ones count once as evidence. Other columns are not used.
    """
    rows = stored(base_spans(docs), "instances")
    occurrences = stored(_occurrences(rows, rule), "occurrences")
    accepted = good_patterns(occurrences, rule)
    new = (occurrences.where("not seed and new").join(accepted.select("pattern"), "pattern")
           .groupBy("row").agg(F.array_sort(F.collect_set(F.struct(F.lit("context").alias("kind"), "start", "end"))).alias("more")))
    return rows.select("doc_id", "row", "base").join(new, "row", "left").select(
        "doc_id", F.concat("base", F.coalesce("more", F.array().cast(f"array<{SPAN}>"))).alias("spans"))
