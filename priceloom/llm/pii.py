"""Personal data by bootstrapped contextual extraction, in DataFrame functions.

Four expressions give the base spans: email, ip, card and phone, leftmost and
non-overlapping in each kind, with offsets in code points. They are the seeds.

Every word with a digit or an at sign is an instance; the words left and right of
it, instances among them, are its lexical patterns. Where the word to the left is
made of marks only, the one before it belongs to the pattern (``token =``); marks
to the right make none. Besides the base spans, words that look like a generated
key (SECRET: 24 or more letters and digits, at least four of these, or a UUID) are
seeds, but they become spans only beside a pattern that counts, as others do.

Spark scores the graph of patterns and instances in ROUNDS rounds. An instance is
as good as its patterns together, 1 - product(1 - score), and a seed scores 1. An
instance outside the base spans that reaches LEAST_INSTANCE is an unseen
identifier, and from then on it counts as a seed with that score. A pattern has
found the sum of the scores of its distinct seeds; its score is found / (found +
against + log10(1 + unknown)), the logarithm counting as 1 at least, times the
share of seeds among all its places in the corpus that are not beside an unknown
instance. So a pattern that goes with ordinary words, as "of" does, scores near
nothing however many seeds happen to stand beside it. Instances that are not seeds
are unknown and do not speak against a pattern, whatever their number, except for
the logarithm, and those that stand between it and a word known to go with other
things: one that stands by no seed of this pattern, and elsewhere by LEAST_SEEDS
instances, and SURER times the pattern's seeds, or more, of which less than
SEEDLESS are seeds. Patterns of at least LEAST_SEEDS distinct seeds and
LEAST_PATTERN score count. Each place of an unseen identifier beside such a
pattern is a span of the kind ``id``.

Offsets, and which places a base span overlaps, are running results by doubling, so
a text of n matches takes n log n steps.
Joins by pattern, instance and row go through ``attach``, which splits hot keys.

The expressions match what their plain forms do, in linear time: a run of
characters is tried once, from its start or the end of the match before, and
runs are not given back.

Defined results: null text counts as empty and has no spans; the digest of no
spans is that of the empty string; repeated rows get equal results each; a null
id is kept; extra columns are not read; any length of text is read whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import attach, text_of, written

KINDS = ("email", "ip", "card", "phone", "id")
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for an expression to match at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
INSTANCE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
MARKS = r"^[^\p{L}\p{N}]++$"
#: Marks around an instance that do not belong to it.
LEADING, TRAILING = r"^[^\p{L}\p{N}@+_]++", r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$"
#: A word, and a word of marks only after it.
MARKED = r"(?<!\S)\S++\s++[^\p{L}\p{N}\s]++(?!\S)"
SECRET = r"^(?:(?=(?:[^0-9]*+[0-9]){4})(?=.*[a-z])[a-z0-9]{24,}|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})$"
ROUNDS, LEAST_SEEDS, LEAST_PATTERN, LEAST_INSTANCE = 3, 3, 0.6, 0.8
SEEDLESS, SURER = 0.05, 2
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _matched(text: Column, name: str, pattern: str, hint: str) -> list[Column]:
    """The texts between the matches, and the matches; null without the hint.
    They are columns of their own so that each expression runs once."""
    has = F.rlike(text, F.lit(hint))
    return [
        F.when(has, F.split(text, pattern, -1)).alias(f"{name}_between"),
        F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias(f"{name}_values"),
    ]


def _blank(text: Column) -> Column:
    return F.translate(text, "\n\t\r\f\x0b", "     ")


def _scanned(values: Column, both) -> Column:
    """Running results of ``both`` over an array, by doubling: ``both`` gets a
    value and the one a step before it, or null."""
    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(values))).cast("int")), lambda k: F.pow(F.lit(2), k).cast("int"))
    return F.aggregate(steps, values, lambda held, step: F.transform(held, lambda x, i: both(x, F.get(held, i - step))))


def _places(name: str, beside: bool = False) -> Column:
    """Matches as (start, value): the texts between the matches give the offsets.
    With ``beside``, also the texts around each match, and the matches around it."""
    between, values = F.col(f"{name}_between"), F.col(f"{name}_values")
    n = F.size(values)
    first = F.slice(between, F.lit(1), n)
    kind, more = "start:int,value:string", []
    if beside:
        kind += ",before:string,after:string,previous:string,next:string"
        earlier = F.concat(F.array(F.lit("")), F.slice(values, F.lit(1), n - 1))
        more = [first, F.slice(between, F.lit(2), n), earlier, F.concat(F.slice(values, F.lit(2), n), F.array(F.lit("")))]
    kind = f"array<struct<{kind}>>"
    lengths = F.zip_with(first, values, lambda b, v: F.char_length(b) + F.char_length(v))
    ends = _scanned(lengths, lambda x, earlier: x + F.coalesce(earlier, F.lit(0)))
    starts = F.zip_with(ends, values, lambda end, v: end - F.char_length(v))
    return F.when(n > 0, F.arrays_zip(starts, values, *more).cast(kind)).otherwise(F.array().cast(kind))


def _luhn(digits: Column) -> Column:
    size = F.char_length(digits)

    def add(total: Column, at: Column) -> Column:
        digit = F.substring(digits, at, F.lit(1)).cast("int")
        twice = digit * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when((size - at) % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """The test a match has to pass."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        digits = F.regexp_replace(value, "[ -]", "")
        return F.char_length(digits).between(14, 19) & _luhn(digits)
    if kind == "phone":
        return F.char_length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def base_spans() -> Column:
    """All base spans of a text, by start and kind, from the columns of
    ``_matched``."""

    def spans(number: int, kind: str) -> Column:
        found = F.filter(_places(kind), lambda place: _holds(kind, place["value"]))
        return F.transform(
            found,
            lambda place: F.struct(
                place["start"].alias("start"),
                F.lit(number).alias("kind"),
                (place["start"] + F.char_length(place["value"])).alias("end"),
            ),
        )

    parts = [
        F.when(F.size(f"{kind}_values") > 0, spans(number, kind)).otherwise(F.array().cast(SPAN))
        for number, kind in enumerate(KINDS[:4])
    ]
    return F.array_sort(F.concat(*parts))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    name = lambda s: F.get(names, s["kind"])
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string")))
    )


def _left(p: Column) -> Column:
    """The word before a place, and the one before that where it is of marks only."""
    before = F.rtrim(_blank(p["before"]))
    word = F.substring_index(before, " ", -1)
    rest = F.rtrim(F.left(before, F.char_length(before) - F.char_length(word)))
    ahead = F.when(rest == "", p["previous"]).otherwise(F.substring_index(rest, " ", -1))
    whole = F.when(F.rlike(word, F.lit(MARKS)), F.ltrim(F.concat(ahead, F.lit(" "), word))).otherwise(word)
    return F.lower(F.when(before == "", p["previous"]).otherwise(whole))


def _right(p: Column) -> Column:
    after = F.ltrim(_blank(p["after"]))
    word = F.when(after == "", p["next"]).otherwise(F.substring_index(after, " ", 1))
    return F.when(F.rlike(word, F.lit(MARKS)), F.lit("")).otherwise(F.lower(word))


def _instances() -> Column:
    """Words with a digit or at sign, without marks around them, and the words
    beside them."""
    def place(p: Column) -> Column:
        open_ = F.regexp_replace(p["value"], LEADING, "")
        lead = F.char_length(p["value"]) - F.char_length(open_)
        bare = F.regexp_replace(open_, TRAILING, "")
        return F.struct(
            (p["start"] + lead).alias("start"),
            (p["start"] + lead + F.char_length(bare)).alias("end"),
            F.lower(bare).alias("instance"),
            _left(p).alias("left"),
            _right(p).alias("right"),
        )

    found = F.transform(_places("word", beside=True), place)
    kind = "array<struct<start:int,end:int,instance:string,left:string,right:string>>"
    return F.when(F.size("word_values") > 0, found).otherwise(F.array().cast(kind))


def _seeded() -> Column:
    """The places with ``seed``, whether a base span overlaps them. In the order
    of the starts of spans and the ends of places, a place is overlapped if a span
    before it ends after its start."""
    kind = "array<struct<at:int,last:int,start:int,end:int,instance:string,left:string,right:string>>"
    spans = F.transform("base", lambda s: F.struct(s["start"], s["end"], *[F.lit(None)] * 5)).cast(kind)
    places = F.transform("places", lambda p: F.struct(p["end"], F.lit(0), p["start"], p["end"], p["instance"], p["left"], p["right"]))
    events = F.array_sort(F.concat(places.cast(kind), spans))
    reach = _scanned(F.transform(events, lambda e: e["last"]), lambda x, earlier: F.greatest(x, earlier))
    fields = ["start", "end", "instance", "left", "right"]
    one = lambda e, seed: F.struct(*[e[f].alias(f) for f in fields], seed.alias("seed"))
    marked = F.filter(F.zip_with(events, reach, lambda e, r: one(e, r > e["start"])), lambda e: e["start"].isNotNull())
    return F.when(F.size("base") == 0, F.transform("places", lambda p: one(p, F.lit(False)))).otherwise(marked)


def _terms(rows: DataFrame) -> DataFrame:
    """(term, total) of every word, and every word with marks after it, in rows
    (text)."""
    pairs = F.transform(F.regexp_extract_all("text", F.lit(MARKED), F.lit(0)), lambda m: F.regexp_replace(m, r"\s++", " "))
    words = rows.select(F.explode(F.concat(F.split("text", r"\s+"), pairs)).alias("term"))
    return words.groupBy(F.lower("term").alias("term")).agg(F.count("*").alias("total"))


def _met(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Left join of stored rows with one row per key, hot keys by broadcast."""
    times = rows.groupBy(key).agg(F.count("*").alias("met"))
    sized = written(groups.join(times, key), "met")
    return attach(rows, sized, [key], "met", rows.count()).drop("met")


def _against(both: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, against): the instances that stand between a pattern and a word
    known to go with other things. ``both`` has (left, right, n, seeds) for the
    distinct instances between two patterns, ``patterns`` (pattern, n, seeds)."""
    # a pattern that cannot count is not judged, and a pair with a seed in it is no evidence
    enough = patterns.filter(F.col("seeds") >= LEAST_SEEDS).select("pattern", F.col("seeds").alias("own"))
    ways = [(F.col(x).alias("pattern"), F.col(y).alias("other"), F.col("n").alias("between")) for x, y in (("left", "right"), ("right", "left"))]
    pairs = both.filter("seeds = 0").select(*ways[0]).unionByName(both.filter("seeds = 0").select(*ways[1]))
    sided = written(pairs.join(enough, "pattern"), "pairs")
    times = sided.groupBy("other").agg(F.count("*").alias("times"))
    known = patterns.select(F.col("pattern").alias("other"), F.col("n").alias("all"), F.col("seeds").alias("all_seeds"))
    rated = attach(sided, written(times.join(known, "other"), "others"), ["other"], "times", sided.count())
    elsewhere = F.col("all") - F.col("between")
    speaks = (elsewhere >= F.greatest(F.lit(LEAST_SEEDS), SURER * F.col("own"))) & (F.col("all_seeds") < SEEDLESS * elsewhere)
    return rated.filter(speaks).groupBy("pattern").agg(F.sum("between").alias("against"))


def _good(edges: DataFrame, triples: DataFrame) -> DataFrame:
    """(pattern, score, times) of the patterns that count, for edges (pattern,
    instance, places, common, known) and triples (left, right, instance, known),
    known being the score of a seed or null."""
    seeds = F.count("known").alias("seeds")
    seen = F.sum(F.when(F.col("known").isNotNull(), F.col("places"))).alias("seen")
    patterns = edges.groupBy("pattern").agg(
        F.count("*").alias("n"), seeds, F.sum("known").alias("found"), seen, F.max("common").alias("common")
    )
    patterns = written(patterns, "patterns")
    both = triples.filter("left != '' and right != ''").groupBy("left", "right").agg(F.count("*").alias("n"), seeds)
    both = both.select(F.concat(F.lit("L "), F.col("left")).alias("left"), F.concat(F.lit("R "), F.col("right")).alias("right"), "n", "seeds")
    enough = patterns.filter(F.col("seeds") >= LEAST_SEEDS)
    judged = enough.join(_against(written(both, "both"), patterns), "pattern", "left")
    against = F.coalesce(F.col("against"), F.lit(0))
    unknown = F.log10(1.0 + F.col("n") - F.col("seeds"))
    score = F.col("found") / (F.col("found") + against + F.greatest(F.lit(1.0), unknown))
    score = score * F.col("seen") / (F.col("seen") + F.col("common"))
    judged = judged.select("pattern", score.alias("score"), F.col("n").alias("times"))
    return written(judged.filter(F.col("score") >= LEAST_PATTERN), "good")


def discovered(places: DataFrame, terms: DataFrame) -> DataFrame:
    """(row_key, start, end) of unseen identifiers, for stored rows (row_key,
    start, end, instance, left, right, seed) and the counts of ``_terms``."""
    known = F.when(F.col("seed"), F.lit(1.0)).alias("known")
    triples = places.groupBy("left", "right", "instance").agg(F.max("seed").alias("here"), F.count("*").alias("places"))
    triples = written(triples, "places-met")
    # an instance that is a seed anywhere is one everywhere
    seeds = triples.filter("here").select("instance", F.lit(True).alias("is_seed")).distinct()
    secret = F.rlike("instance", F.lit(SECRET))
    seed = F.coalesce("is_seed", F.lit(False))
    triples = _met(triples, seeds, "instance").select("left", "right", "instance", "places", seed.alias("base"), (seed | secret).alias("seed"))
    triples = written(triples, "triples")
    sides = F.explode(F.array(F.concat(F.lit("L "), F.col("left")), F.concat(F.lit("R "), F.col("right"))))
    edges = triples.select(sides.alias("pattern"), "instance", "places", "base", "seed").filter(F.char_length("pattern") > 2)
    edges = edges.groupBy("pattern", "instance").agg(F.max("base").alias("base"), F.max("seed").alias("seed"), F.sum("places").alias("places"))
    edges = written(edges, "pattern-instances")
    held = edges.groupBy("pattern").agg(F.sum("places").alias("held"))
    held = held.withColumn("term", F.substring("pattern", 3, 1 << 30)).join(terms, "term", "left")
    # a run of marks that is no term is beside nothing that is counted, and does not count
    common = F.greatest(F.coalesce(F.col("total") - F.col("held"), F.lit(1 << 40)), F.lit(0))
    edges = written(_met(edges, held.select("pattern", common.alias("common")), "pattern"), "edges")
    total = edges.count()
    with_known = lambda t: t.withColumn("known", known)
    good = _good(with_known(edges), with_known(triples))
    sure = _sure(edges, good, total)
    for _ in range(ROUNDS - 1):
        if sure.isEmpty():
            break  # no new seeds, so no other scores
        more = [
            _met(t, sure, "instance").withColumn("known", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.col("sure")))
            for t in (edges, triples)
        ]
        good = _good(*more)
        sure = _sure(edges, good, total)
    placed = _met(places, sure, "instance").filter(F.col("sure").isNotNull() & ~F.col("seed"))
    beside = written(placed.select("row_key", "start", "end", sides.alias("pattern")), "beside")
    beside = _met(beside, good.select("pattern", "score"), "pattern").filter(F.col("score").isNotNull())
    return beside.select("row_key", "start", "end").distinct()


def _sure(edges: DataFrame, good: DataFrame, total: int) -> DataFrame:
    """(instance, sure) of the unseen identifiers."""
    rated = attach(edges.filter(~F.col("base")), good, ["pattern"], "times", total)
    together = 1 - F.exp(F.sum(F.log1p(-F.coalesce(F.col("score"), F.lit(0.0)))))
    rated = rated.groupBy("instance").agg(together.alias("sure"))
    return written(rated.filter(F.col("sure") >= LEAST_INSTANCE), "sure")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, and n_found,
    the number of spans that the patterns added, of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    text = F.col("text")
    matched = [c for kind in KINDS[:4] for c in _matched(text, kind, PATTERNS[kind], HINTS[kind])]
    rows = rows.select(
        "doc_id",
        F.xxhash64("doc_id", F.xxhash64("text")).alias("row_key"),
        *matched,
        *_matched(text, "word", INSTANCE, "[0-9@]"),
    )
    terms = written(_terms(docs.select(text_of().alias("text"))), "terms")
    rows = rows.select("doc_id", "row_key", base_spans().alias("base"), _instances().alias("places"))
    rows = written(rows, "pii-rows")
    placed = rows.filter(F.size("places") > 0).select("row_key", F.explode(_seeded()).alias("p")).select("row_key", "p.*")
    added = discovered(written(placed, "places"), terms)
    kind = F.lit(KINDS.index("id")).alias("kind")
    more = added.groupBy("row_key").agg(F.collect_list(F.struct("start", kind, "end")).alias("more"))
    some = F.size("places") > 0
    whole = _met(rows.filter(some), more, "row_key").unionByName(
        rows.filter(~some).withColumn("more", F.lit(None).cast(SPAN))
    )
    more = F.coalesce("more", F.array().cast(SPAN))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return whole.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:4])],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", more))).alias("spans"),
        F.size(more).cast("long").alias("n_found"),
    )
