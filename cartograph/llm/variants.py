"""Spelling variants of the corpus vocabulary by a variable-length gram index.

Words are counted over all texts; two words are near if one inserted, deleted or replaced code point
turns one into the other.  Near words are found without comparing all words:

* gram dictionary: every word, between the marks ``^`` and ``$``, is cut into all its grams of
  SHORTEST to LONGEST code points; those found more than a threshold of times are the dictionary.
  The threshold is at least LIST and at least one DICTIONARY-th of all positions, so no length has more
  than DICTIONARY frequent grams, whatever the size of the corpus;
* decomposition: at each position a word has the shortest gram that is not frequent (or the one of
  LONGEST code points).  Whether a gram grows depends on its own letters only, and the mark ``$`` is never
  edited, so one edit changes exactly the grams that lie over it;
* affected grams: ``bound`` is the largest number of a word's grams over one of its letters, so two near
  words share all but ``bound`` of the grams of each.  With LONGEST = 5 a word of 5 letters has
  6 grams and a bound of 5 at most, so every near pair shares a gram;
* list merging: of a word's grams in one order of all grams (rare ones first) only the first
  ``bound + 1`` need to be merged: the first gram that an edit leaves alone is among them in both
  words.  Lists are kept by (gram, position, length): an edit that keeps the length keeps the
  position, a longer word has the gram at the same position or one later;
* verification: an exact edit distance of one.

Each word's form is its near word of largest count (ties: smallest in code-point order) if that is at
least twice its own; the root follows forms to the last.  Counts at least double along the way, so the
pointer doubling below ends after a few rounds.

Defined results: null and empty texts have no words; very long texts are read whole; repeated rows count
again; a null key counts as the empty text in the key of the deletion rule; an empty table, or one
without a frequent word, gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.llm.urlfilter import LOWER, UPPER
from cartograph.session import materialize

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, DROP = 5, 3, 97
SHORTEST, LONGEST = 2, 5
LIST, DICTIONARY = 32, 65_536


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n, size of the words of all texts with LEAST_LENGTH code points and LEAST_COUNT uses."""
    runs = F.filter(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(RUN), F.lit(0)), lambda r: F.length(r) >= LEAST_LENGTH)
    each = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("__key"), F.explode(runs).alias("__run")) \
        .select("__key", F.translate("__run", UPPER, LOWER).alias("__run"))
    h = F.crc32(F.concat(F.col("__key"), F.lit(":"), F.col("__run")).cast("binary"))
    at = F.pmod(h, F.length("__run")).cast("int")
    cut = F.concat(F.substring(F.col("__run"), F.lit(1), at), F.substring(F.col("__run"), at + 2, F.length("__run")))
    word = F.when(h % DROP == 0, cut).otherwise(F.col("__run"))
    return (each.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)
            .withColumn("size", F.length("word")))


def frequent_grams(words: DataFrame) -> DataFrame:
    """gram, uses of the grams found more often than the threshold: at most DICTIONARY a length."""
    positions = words.agg(F.sum(F.col("size") + 1)).first()[0] or 0
    threshold = max(LIST, -(-positions // DICTIONARY))
    marked = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    lengths = F.array(*[F.lit(q) for q in range(SHORTEST, LONGEST + 1)])
    grams = F.flatten(F.transform(
        F.sequence(F.lit(1), F.col("size") + 1),
        lambda p: F.transform(F.filter(lengths, lambda q: p + q <= F.col("size") + 3), lambda q: F.substring(marked, p, q))))
    return words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("uses")) \
        .where(F.col("uses") > threshold)


def decompose(words: DataFrame, frequent: DataFrame) -> DataFrame:
    """word, size, p, take, uses: at each position p (from 1, in the marked word) a gram of ``take`` code points.

    ``uses`` is 0 for grams below the threshold."""
    marked = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    at = words.select("word", "size", F.explode(F.sequence(F.lit(1), F.col("size") + 1)).alias("p")) \
        .withColumn("room", F.col("size") + 3 - F.col("p"))
    for q in range(SHORTEST, LONGEST + 1):
        # at most DICTIONARY short rows each, by the threshold
        table = F.broadcast(frequent.where(F.length("gram") == q).select(F.col("gram").alias(f"g{q}"), F.col("uses").alias(f"u{q}")))
        at = at.join(table, F.col(f"g{q}") == F.when(F.col("room") >= q, F.substring(marked, F.col("p"), F.lit(q))), "left")
    grown = sum((F.col(f"u{q}").isNotNull().cast("int") for q in range(SHORTEST, LONGEST)), F.lit(SHORTEST))
    at = at.withColumn("take", F.least(grown, "room"))
    # a gram taken though frequent could not grow: it has the greatest length or ends at the mark
    uses = F.coalesce(*[F.when(F.col("take") == q, F.col(f"u{q}")) for q in range(SHORTEST, LONGEST + 1)], F.lit(0))
    return at.select("word", "size", "p", "take", uses.alias("uses"))


def merged_lists(grams: DataFrame) -> DataFrame:
    """word, size, gram, p of the first ``bound + 1`` grams of every word, rare ones first."""
    marked = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    gram = F.substring(marked, F.col("p"), F.col("take"))
    # p is part of the order, so that grams used twice in a word have one order in both near words
    one = F.struct(F.col("uses"), F.xxhash64(gram).alias("h"), F.col("p"), F.col("take"))
    spans = grams.groupBy("word", "size").agg(F.sort_array(F.collect_list(one)).alias("grams"))
    over = F.transform(F.sequence(F.lit(2), F.col("size") + 1), lambda i: F.size(
        F.filter("grams", lambda g: (g["p"] <= i) & (i < g["p"] + g["take"]))))
    return (spans.select("word", "size", F.explode(F.slice("grams", 1, F.array_max(over) + 1)).alias("g"))
            .select("word", "size", F.col("g.p").alias("p"), F.col("g.take").alias("take"))
            .select("word", "size", "p", gram.alias("gram")))


def near_words(words: DataFrame) -> DataFrame:
    """Both directions of every near pair, once: word, other."""
    grams = decompose(words, materialize(frequent_grams(words), "variant-grams"))
    index = materialize(merged_lists(grams), "variant-index")
    # a word looks for words of its length, and for shorter ones at its position or the one before
    look = F.array(F.struct(F.col("size").alias("s"), F.col("p").alias("q")),
                   F.struct((F.col("size") - 1).alias("s"), F.col("p").alias("q")),
                   F.struct((F.col("size") - 1).alias("s"), (F.col("p") - 1).alias("q")))
    probes = index.select(F.col("word").alias("a"), F.col("size").alias("from"), "gram", F.explode(look).alias("at")) \
        .select("a", "from", "gram", F.col("at.s").alias("size"), F.col("at.q").alias("p"))
    pairs = (probes.join(index, ["gram", "size", "p"])
             .where(((F.col("from") > F.col("size")) | (F.col("a") < F.col("word"))) & (F.levenshtein("a", "word", 1) == 1))
             .select("a", F.col("word").alias("b")).distinct())
    pairs = materialize(pairs, "variant-pairs")
    return pairs.select(F.col("a").alias("word"), F.col("b").alias("other")) \
        .unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every word that has a form (word, form): pointers doubled until none moves."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        after = at.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        at = materialize(
            at.join(after, F.col("root") == F.col("__w"), "left")
            .select("word", F.coalesce("__r", "root").alias("root"), F.col("__r").isNotNull().alias("moved")), "variant-roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary of ``docs``."""
    words = materialize(vocabulary(docs, key, text), "variant-words")
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("m"))
    best = F.min(F.struct((-F.col("m")).alias("less"), "other"))
    near = near_words(words).join(counts, "other").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form = F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best.other"))
    named = materialize(
        words.join(near, "word", "left")
        .select("word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                F.when(form.isNotNull(), -F.col("best.less")).alias("form_n")), "variant-forms")
    root = roots(named.where("form is not null").select("word", "form"))
    return named.join(root, "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
