"""Personal data: fixed kinds by pattern, further identifiers by bootstrapped contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonstar.llm.common import store

#: Kinds in the order in which spans with the same start are listed. Quantifiers are possessive where nothing after them could
#: make them give back, and a match may not start inside a run that the search has already been through, so the
#: time and stack of a search do not grow with the length of a run. The matches are those of the plain patterns.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: The kind of spans that contexts discover, listed last.
FOUND = "id"
ORDER = (*KINDS, FOUND)

#: What may be an identifier of an unknown kind: a run of letters, digits, _ and - with so many characters and digits.
TOKEN = r"(?<![A-Za-z0-9_-])[A-Za-z_-]*+[0-9][A-Za-z0-9_-]*+"
TOKEN_CHARS, TOKEN_DIGITS = 7, 3
#: Characters on either side that contexts are taken from.
CONTEXT_CHARS = 64
#: Lexical patterns: the last word before with what follows it, the last two words, the first word after.
_IN, _OUT = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
CONTEXTS = {"L1": f"({_IN}+{_OUT}*)$", "L2": f"({_IN}+{_OUT}+{_IN}+{_OUT}*)$", "R1": f"^({_OUT}*{_IN}+)"}
#: The same at every word of a text, whatever stands beside it.
EVERYWHERE = {
    "L1": f"({_IN}++{_OUT}*+)",
    "L2": f"(?<!{_IN})(?=({_IN}++{_OUT}++{_IN}++{_OUT}*+)){_IN}++",
    "R1": f"({_OUT}++{_IN}++)",
}
#: Names with which an identifier is told, before a sign of assignment. What they introduce is a seed entity, as the fixed kinds are.
LABELS = (
    "account", "api_key", "customer_id", "iban", "key", "license", "passport", "password", "secret", "ssn", "tax_id", "token", "user_id",
)
LABELLED = rf"(?:^|[^a-z_])(?:{'|'.join(LABELS)})\s?[:=#]\s?[\x22\x27]?$"
#: Confidences and scores are whole millionths, so that sums are exact in any order.
UNIT = 1_000_000
#: Rounds of scoring, different known instances that a pattern needs, and the least score of a pattern that discovers.
ROUNDS, MIN_INSTANCES, MIN_SCORE = 3, 5, 800_000

SPAN = "struct<start:int,kind_no:int,stop:int,value:string>"


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _matches(text: Column, pattern: str, kind_no: int) -> Column:
    """All matches with their places in code points: the texts between matches and the matches, laid end to end."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pieces = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("value"))
    start = F.struct(F.lit(0).alias("at"), _empty(SPAN).alias("out"))

    def step(done: Column, piece: Column) -> Column:
        at = done["at"] + F.length(piece["gap"])
        stop = at + F.length(piece["value"])
        span = F.struct(at.alias("start"), F.lit(kind_no).alias("kind_no"), stop.alias("stop"), piece["value"].alias("value"))
        return F.struct(stop.alias("at"), F.array_append(done["out"], span).alias("out"))

    placed = F.aggregate(pieces, start, step, lambda done: done["out"])
    return F.when(F.size(found) > 0, placed).otherwise(_empty(SPAN))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _byte(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+", "")
    return (F.length(short) <= 3) & (F.coalesce(short.try_cast("int"), F.lit(0)) <= 255)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _byte)
    if kind == "card":
        fits = F.length(_digits(value)).between(14, 19)
        return F.when(fits, _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans of the fixed kinds, as an array sorted by start, then kind."""
    found = [_kept(text, kind, pattern, i) for i, (kind, pattern) in enumerate(KINDS.items())]
    return F.array_sort(F.concat(*found))


def _kept(text: Column, kind: str, pattern: str, kind_no: int) -> Column:
    spans = F.filter(_matches(text, pattern, kind_no), lambda span: _valid(kind, span["value"]))
    return F.when(F.contains(text, F.lit("@")), spans).otherwise(_empty(SPAN)) if kind == "email" else spans


def listed(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*map(F.lit, ORDER))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"], s["stop"])), ",")


def _plain(text: Column) -> Column:
    """Lower case, one space for white space, 0 for each digit: numbers around a mention do not make contexts unique."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"\s+", " "), "[0-9]", "0")


def _mentions(text: Column) -> Column:
    """Each base span and each other identifier of a text, with the lexical patterns around it, as an array."""
    tokens = F.filter(
        _matches(text, TOKEN, len(KINDS)),
        lambda t: (F.length(t["value"]) >= TOKEN_CHARS)
        & (F.length(_digits(t["value"])) >= TOKEN_DIGITS)
        & ~F.exists("base", lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"])),
    )

    def mention(m: Column) -> Column:
        room = F.least(m["start"], F.lit(CONTEXT_CHARS))
        sides = {"L": F.substring(text, m["start"] - room + 1, room), "R": F.substring(text, m["stop"] + 1, F.lit(CONTEXT_CHARS))}
        contexts = [
            F.concat(F.lit(f"{name} "), F.nullif(F.regexp_extract(_plain(sides[name[0]]), regex, 1), F.lit("")))
            for name, regex in CONTEXTS.items()
        ]
        fixed = m["kind_no"] < len(KINDS)
        return F.struct(
            m["start"].alias("start"), m["stop"].alias("stop"), F.lower(m["value"]).alias("instance"), fixed.alias("fixed"),
            (fixed | _plain(sides["L"]).rlike(LABELLED)).alias("seed"), F.array_compact(F.array(*contexts)).alias("patterns"),
        )

    return F.transform(F.concat("base", tokens), mention)


def occurrences(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """pattern, total: how often each wanted pattern stands in the texts, whatever it stands beside."""
    def every(name: str) -> DataFrame:
        context = F.explode(F.regexp_extract_all(_plain(F.col("text")), F.lit(EVERYWHERE[name]), F.lit(1)))
        short = texts.select(context.alias("context")).filter(F.length("context") <= CONTEXT_CHARS)
        return short.select(F.concat(F.lit(f"{name} "), "context").alias("pattern"))

    l1, l2, r1 = map(every, EVERYWHERE)
    return l1.unionAll(l2).unionAll(r1).join(wanted, "pattern").groupBy("pattern").agg(F.count("*").alias("total"))


def patterns(mentions: DataFrame, texts: DataFrame) -> DataFrame:
    """High-confidence patterns: pattern, score.

    Patterns and instances form a graph with an edge where an instance stands in a pattern. Seed entities start at
    full confidence, all others at none. In each round a pattern scores the confidence of what stands in it over all its
    places in the texts, words that are no identifiers included (one unknown place added, so that few count for less):
    a frequent word before a few seeds discovers nothing. An unknown instance gets the chance that one of its
    high-scoring patterns is right. The graph is one row per pair, whatever the number of copies; scores are joined
    in, and Spark splits the edges of a frequent pattern.
    """
    edges = mentions.select(F.explode("patterns").alias("pattern"), "instance", "seed")
    edges = store(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("n")), "edges")
    met = edges.groupBy("pattern").agg(F.count("*").alias("instances"), F.sum("n").alias("mentions"))
    met = store(met.filter(F.col("instances") >= MIN_INSTANCES).drop("instances"), "met")
    places = met.join(occurrences(texts, met.select("pattern")), "pattern", "left")
    places = store(places.select("pattern", F.greatest("mentions", F.coalesce("total", F.lit(0))).alias("total")), "places")
    instances = store(
        edges.groupBy("instance").agg(F.when(F.max("seed"), UNIT).otherwise(0).cast("long").alias("confidence")), "instances"
    )
    scored = None
    for _ in range(ROUNDS):
        belief = edges.join(instances, "instance").groupBy("pattern")
        belief = belief.agg(F.sum(F.col("confidence") * F.col("n")).alias("held"), F.sum("confidence").alias("known"))
        belief = belief.filter(F.col("known") >= MIN_INSTANCES * UNIT).join(places, "pattern")
        scored = belief.selectExpr("pattern", "held div (total + 1) as score").filter(F.col("score") >= MIN_SCORE)
        scored = store(scored, "patterns")
        doubt = F.sum(F.round(F.log(1 - F.col("score") / UNIT) * UNIT).cast("long")) / UNIT
        chance = F.round((1 - F.exp(doubt)) * UNIT).cast("long")
        held = edges.join(scored, "pattern").groupBy("instance").agg(chance.alias("_chance"))
        confidence = F.when(F.col("confidence") == UNIT, F.col("confidence")).otherwise(F.coalesce("_chance", F.lit(0)))
        instances = store(instances.join(held, "instance", "left").select("instance", confidence.alias("confidence")), "instances")
    return scored


def find(docs: DataFrame) -> DataFrame:
    """Personal data in each row: doc_id, text_hash, base, spans (arrays of start, kind_no, stop, value, sorted).

    `base` are the fixed kinds, by pattern and check; `spans` adds the identifiers that stand in a high-confidence
    pattern learned over all documents and overlap no base span. Seed entities are the base spans and what a name of
    `LABELS` introduces; the latter are added only where a pattern holds, too. Places are code points, the end exclusive.

    `docs` needs `doc_id` and `text`; other columns are ignored. Null and empty texts have no spans, repeated rows get
    equal spans, a null doc_id is a document. No rows give no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), text.alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    rows = store(rows.withColumn("mentions", _mentions(F.col("text"))).drop("text"), "mentions")
    mentions = rows.select("doc_id", "text_hash", F.explode("mentions").alias("m")).select("doc_id", "text_hash", "m.*")
    good = patterns(mentions, docs.select(text.alias("text")))
    unknown = mentions.filter(~F.col("fixed")).withColumn("pattern", F.explode("patterns"))
    span = F.struct("start", F.lit(len(KINDS)).alias("kind_no"), "stop", F.col("instance").alias("value"))
    more = unknown.join(good, "pattern").groupBy("doc_id", "text_hash").agg(F.collect_set(span).alias("more"))
    more = more.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "more")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    found = rows.join(more, same, "left")
    spans = F.array_sort(F.concat("base", F.coalesce("more", _empty(SPAN))))
    return found.select("doc_id", "text_hash", "base", spans.alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans are one, of the first's kind."""
    names = F.array(*map(lambda k: F.lit(f"[{k.upper()}]"), ORDER))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        fresh = F.concat(done["out"], F.substring(text, done["at"] + 1, span["start"] - done["at"]), F.get(names, span["kind_no"]))
        apart = span["start"] >= done["at"]
        return F.struct(F.greatest(done["at"], span["stop"]).alias("at"), F.when(apart, fresh).otherwise(done["out"]).alias("out"))

    def rest(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))

    return F.aggregate(spans, start, step, rest)
