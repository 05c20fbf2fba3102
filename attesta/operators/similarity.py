"""Set similarity by an inverted index of tokens, and tiered, unique-only resolution of names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Up to this many edits similar words are found by what is left of them without as many letters; beyond it by their parts.
SPARED = 2


def jaccard_pairs(sets: DataFrame, key: str = "id", tokens: str = "tokens", threshold: float = 0.6) -> DataFrame:
    """Unordered pairs of rows whose token sets have a Jaccard similarity of at least ``threshold``.

    Equal sets are folded to one class first. Tokens are numbered from rare to frequent and only the
    prefix that a match must touch is indexed, so that frequent tokens pair nobody; sizes filter the
    rest before the exact test. Returns (a, b, score, identical) over classes' least keys, plus pairs
    (least key, key) inside each class.
    """
    clean = sets.where(F.size(tokens) > 0).select(F.col(key).alias("k"), F.sort_array(tokens).alias("t"))
    classes = clean.groupBy("t").agg(F.min("k").alias("k"))
    freq = classes.select(F.explode("t").alias("w")).groupBy("w").agg(F.count("*").alias("f"))
    ordered = classes.select("k", F.explode("t").alias("w")).join(freq, "w").groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("f", "w"))), lambda x: x["w"]).alias("t"))
    n = F.size("t")
    prefix = n - F.ceil(F.lit(threshold) * n).cast("int") + 1
    index = ordered.select("k", "t", n.alias("n"), F.explode(F.slice("t", F.lit(1), prefix)).alias("w"))
    other = index.select(F.col("k").alias("k2"), F.col("t").alias("t2"), F.col("n").alias("n2"), "w")
    near = (F.col("k") < F.col("k2")) & (F.least("n", "n2") >= F.lit(threshold) * F.greatest("n", "n2"))
    pairs = index.join(other, "w").where(near).groupBy("k", "k2").agg(F.first("t").alias("t"), F.first("t2").alias("t2"))
    common = F.size(F.array_intersect("t", "t2"))
    score = common / (F.size("t") + F.size("t2") - common)
    across = pairs.select(F.col("k").alias("a"), F.col("k2").alias("b"), F.round(score, 3).alias("score"), F.lit(False).alias("identical")).where(score >= threshold)
    first = F.min("k").over(Window.partitionBy("t"))
    inside = clean.select(first.alias("a"), F.col("k").alias("b"), F.lit(1.0).alias("score"), F.lit(True).alias("identical")).where("a < b")
    return across.unionByName(inside)


def resolve_tiers(asked: DataFrame, tiers: list[DataFrame], key: str, found: str) -> DataFrame:
    """(key, found, tier, state): the first tier with hits decides; more than one hit there is a queue, never a guess.

    ``tiers`` hold (key, found) hits, strongest first.
    """
    hits = reduce(DataFrame.unionByName, [t.select(key, found, F.lit(k).alias("tier")) for k, t in enumerate(tiers)]).distinct()
    best = hits.groupBy(key).agg(F.min("tier").alias("tier"))
    top = hits.join(best, [key, "tier"]).groupBy(key, "tier").agg(F.count("*").alias("n"), F.min(found).alias(found))
    state = F.when(F.col("n").isNull(), "none").when(F.col("n") == 1, "resolved").otherwise("ambiguous")
    return asked.select(key).distinct().join(top, key, "left").select(key, F.when(F.col("n") == 1, F.col(found)).alias(found), "tier", state.alias("state"))


def resolve_values(asked: DataFrame, tiers: list[DataFrame], key: str, value: str, found: str) -> DataFrame:
    """As ``resolve_tiers``, for one asked ``value`` a key: ``tiers`` hold (value, found), and hits are counted by value before any key meets them."""
    hits = reduce(DataFrame.unionByName, [t.select(value, found, F.lit(k).alias("tier")) for k, t in enumerate(tiers)]).distinct()
    counted = hits.groupBy(value, "tier").agg(F.count("*").alias("n"), F.min(found).alias(found))
    best = counted.groupBy(value).agg(F.min_by(F.struct("tier", "n", found), "tier").alias("top")).select(value, "top.*")
    state = F.when(F.col("n").isNull(), "none").when(F.col("n") == 1, "resolved").otherwise("ambiguous")
    return asked.join(best, value, "left").select(key, F.when(F.col("n") == 1, F.col(found)).alias(found), "tier", state.alias("state"))


def literal_mentions(texts: DataFrame, names: DataFrame, key: str = "claim_id", body: str = "verbatim", words: int = 2) -> DataFrame:
    """(key, subject_id, span_start, span_end, matched_text): names of ``words`` or more in texts, whole words, any letter case.

    Names are looked up by their first two words through an index, so a text meets only names whose
    beginning it holds. Longer names win over those inside them.
    """
    split = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}_]+)"))
    named = names.select("subject_id", "name", split(F.col("name")).alias("w")).where(F.size("w") >= words).select("subject_id", "name", F.col("w")[0].alias("w0"), F.col("w")[1].alias("w1"))
    pairs = texts.select(key, split(F.col(body)).alias("w")).where(F.size("w") >= 2)
    grams = pairs.select(key, F.explode(F.array_distinct(F.arrays_zip(F.slice("w", F.lit(1), F.size("w") - 1).alias("w0"), F.slice("w", F.lit(2), F.size("w") - 1).alias("w1")))).alias("g")).select(key, "g.w0", "g.w1")
    # pairs of words travel without their texts; only what meets a name gets its text back
    met = grams.join(named, ["w0", "w1"]).select(key, "subject_id", "name").distinct().join(texts.select(key, body), key)
    low, sought = F.lower(body), F.lower("name")
    times = F.floor((F.char_length(low) - F.char_length(F.replace(low, sought))) / F.char_length(sought)).cast("int")
    # the k-th place is as far in as what stands before the k-th occurrence
    starts = F.when(times > 0, F.transform(F.sequence(F.lit(1), times), lambda k: F.char_length(F.call_function("substring_index", low, sought, k)) + 1))
    at = met.select(key, "subject_id", body, F.explode(starts).alias("p"), F.char_length("name").alias("n"))
    edge = lambda c: ~c.rlike(r"^[\p{L}\p{N}_]$")
    whole = edge(F.when(F.col("p") > 1, F.substr(F.col(body), F.col("p") - 1, F.lit(1))).otherwise("")) & edge(F.substr(F.col(body), F.col("p") + F.col("n"), F.lit(1)))
    spans = at.where(whole).select(key, "subject_id", (F.col("p") - 1).alias("span_start"), (F.col("p") - 1 + F.col("n")).alias("span_end"), F.substr(F.col(body), F.col("p"), F.col("n")).alias("matched_text")).distinct()
    w = Window.partitionBy(key).orderBy("span_start", F.desc("span_end"), "subject_id").rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("reach", F.max("span_end").over(w)).where("reach is null or span_end > reach").drop("reach")


def multiset_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Values by key with how often each side has them, where the counts differ."""
    left = a.groupBy(*keys).agg(F.count("*").alias("in_a"))
    right = b.groupBy(*keys).agg(F.count("*").alias("in_b"))
    both = left.join(right, keys, "full").fillna(0, ["in_a", "in_b"])
    return both.where("in_a <> in_b")


#: Passages too short for an anchor are sought in blocks of this many.
SHORT_BLOCK = 1000


def _word_runs(words: Column, k: int) -> Column:
    """Runs of k words, repeats included; the whole where there are fewer."""
    return words if k == 1 else F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, F.lit(k)), " "))


def contained(docs: DataFrame, passages: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", passage: str = "passage") -> DataFrame:
    """(key, item) for each document and passage that stands in it letter for letter.

    A passage of three words or more has inner words, which a text that holds it has whole; up to three of
    them in a row, the longest such run, are looked up among the runs of the texts, and only what meets
    there is compared. Shorter passages are a query set that every text is asked for, in blocks.
    """
    w, n = F.split(F.col(passage), " "), F.size(F.split(F.col(passage), " "))
    inner = F.slice(w, F.lit(2), F.greatest(n - 2, F.lit(0)))
    width = F.least(F.size(inner), F.lit(3))
    known = passages.where(F.col(passage).isNotNull()).select(F.col(item).alias("_item"), F.col(passage).alias("_passage"), inner.alias("_inner"), width.alias("_n"))
    runs = F.transform(F.sequence(F.lit(1), F.size("_inner") - F.col("_n") + 1), lambda k: F.array_join(F.slice("_inner", k, F.col("_n")), " "))
    longest = F.reduce(runs, F.lit(""), lambda best, x: F.when(F.char_length(x) > F.char_length(best), x).otherwise(best))
    anchored = known.where("_n > 0").select("_item", "_passage", "_n", longest.alias("_g"))
    body = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    sizes = [r["_n"] for r in anchored.select("_n").distinct().collect()]  # three rows at most
    split = body.select("_key", F.split("_text", " ").alias("_w"))  # a column, as a lambda would split the text for every run
    met = None
    for k in sizes:
        found = split.select("_key", F.explode(_word_runs(F.col("_w"), k)).alias("_g")).join(anchored.where(F.col("_n") == k).drop("_n"), "_g").select("_key", "_item", "_passage").distinct()
        met = found if met is None else met.unionAll(found)
    if met is None:
        met = anchored.select(F.lit(None).cast(docs.schema[key].dataType).alias("_key"), "_item", "_passage").where("false")
    long_ = met.join(body, "_key").where(F.contains("_text", "_passage")).select("_key", "_item")
    blocks = known.where("_n <= 0").groupBy(F.pmod(F.xxhash64("_passage"), F.lit(2**20)).alias("_b")).agg(F.collect_list(F.struct("_item", "_passage")).alias("_short"))
    number = F.floor((F.row_number().over(Window.orderBy("_b")) - 1) / SHORT_BLOCK)
    asked = blocks.withColumn("_b", number).groupBy("_b").agg(F.flatten(F.collect_list("_short")).alias("_short"))
    if known.where("_n <= 0").isEmpty():
        found = long_
    else:
        short = body.join(asked, F.lit(True)).select("_key", F.explode(F.filter("_short", lambda p: F.contains("_text", p["_passage"]))).alias("p")).select("_key", "p._item")
        found = long_.unionAll(short)
    return found.select(F.col("_key").alias(key), F.col("_item").alias(item))


def _edits(length: Column, least: float) -> Column:
    """The most edits that leave a similarity of ``least`` when the longer word has ``length`` letters."""
    return F.floor(length * (1 - least) + 1e-9).cast("int")


def _without_one(strings: Column) -> Column:
    """All that is left of any of the strings without one of its letters."""
    less = lambda w: F.transform(F.sequence(F.lit(1), F.char_length(w)), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))
    return F.array_distinct(F.flatten(F.transform(F.filter(strings, lambda w: w != ""), less)))


def edit_pairs(words: DataFrame, word: str = "word", least: float = 0.8) -> DataFrame:
    """(a, b, distance, similarity) for all pairs of different words whose similarity, 1 - edits / longer length, is at least ``least``; a < b.

    Exact, by what is left of words without some letters: with k edits between them the longer word without k letters and the shorter without
    k less their difference in length have a string in common. Up to SPARED edits words stand under all such strings. Under more, the
    shorter word is cut into half as many parts, and one, so that one part has an edit at most; it stands under its parts, whole and without a letter, and the
    longer word asks for its stretches at places that near. Unlike short parts, such strings are shared by few words but those that
    are alike. Null and empty words are left out.
    """
    named = words.select(F.col(word).alias("w")).where("w <> ''").distinct().withColumn("n", F.char_length("w"))
    # each word under every length that the longer of a pair may have
    under = named.withColumn("m", F.explode(F.sequence("n", F.greatest(F.col("n"), F.floor(F.col("n") / least + 1e-9).cast("int"))))).withColumn("k", _edits(F.col("m"), least)).where("m - n <= k")
    n, m, k, i = F.col("n"), F.col("m"), F.col("k"), F.col("i")
    spared = k - (m - n)
    left = F.when(spared == 0, F.array("w")).when(spared == 1, _without_one(F.array("w"))).otherwise(_without_one(_without_one(F.array("w"))))
    whole = under.where(k <= SPARED).select("w", "n", "m", "k", F.explode(left).alias("left")).select("w", "n", "m", "k", F.xxhash64("m", "left").alias("key"))
    parts = F.floor(k / 2).cast("int") + 1
    begin = lambda n, i: F.floor(n * i / parts).cast("int")
    cut = F.substr("w", begin(n, i) + 1, begin(n, i + 1) - begin(n, i))
    cuts = under.where(k > SPARED).withColumn("i", F.explode(F.sequence(F.lit(0), parts - 1))).select("w", "n", "k", "m", "i", F.explode(F.concat(F.array(cut), _without_one(F.array(cut)))).alias("left"))
    held = cuts.select(F.col("w").alias("short"), n.alias("shorter"), F.xxhash64("m", "n", "i", "left").alias("key"))
    # here m is the shorter word's length; the parts before and after a stretch leave it this much play
    asks = named.withColumn("k", _edits(n, least)).where(k > SPARED).withColumn("m", F.explode(F.sequence(F.greatest(F.lit(1), n - k), n))).withColumn("i", F.explode(F.sequence(F.lit(0), parts - 1)))
    play, size = F.floor((k - (n - m)) / 2).cast("int"), begin(m, i + 1) - begin(m, i)
    placed = asks.withColumn("at", F.explode(F.sequence(F.greatest(F.lit(0), begin(m, i) - play), F.greatest(F.lit(0), begin(m, i) + (n - m) + play))))
    stretch = lambda more: F.substr("w", F.col("at") + 1, F.greatest(F.lit(0), size + more))
    strings = F.array_distinct(F.concat(F.array(stretch(0), stretch(-1)), _without_one(F.array(stretch(0), stretch(1)))))
    asked = placed.select("w", "n", "k", "m", "i", F.explode(strings).alias("left")).select(F.col("w").alias("long"), "n", "k", F.xxhash64("n", "m", "i", "left").alias("key"))
    by_whole = whole.where("n = m").select(F.col("w").alias("long"), "n", "k", "key").join(whole.select(F.col("w").alias("short"), n.alias("shorter"), "key"), "key")
    met = by_whole.unionByName(asked.distinct().join(held, "key")).where((F.col("n") > F.col("shorter")) | ((F.col("n") == F.col("shorter")) & (F.col("short") < F.col("long"))))
    told = met.select("short", "long", "n", "k", F.levenshtein("short", "long").alias("distance")).where("distance <= k").distinct()
    return told.select(F.least("short", "long").alias("a"), F.greatest("short", "long").alias("b"), "distance", F.round(1 - F.col("distance") / F.col("n"), 4).alias("similarity"))
