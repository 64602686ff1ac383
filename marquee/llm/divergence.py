"""Quality rules on distributions, in DataFrame functions only.

Each text gives two histograms: its characters by class and its words by a list of common words
(and "any other word"). Both are compared with the histogram of all texts of the text's language by
the Jensen-Shannon distance (base 2, so 0 to 1). Texts below a minimum length are not judged by the
distance: too few characters or words make a histogram that says nothing.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.frames import bound, words_of
from marquee.session import written

# Very common short words of the languages served. Lower case.
COMMON_WORDS = (
    "the of and to in a is that for it was on are as with be by this from or "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als für "
    "de la le et les des en un du une que est pour qui dans par sur pas au "
    "el y los del se las por con no su para al lo como"
).split()

# Character classes that a pattern counts. Blanks, bytes above ASCII and the rest
# (lower-case letters, above all) follow from lengths. The fourth and fifth are the rules' symbols.
PATTERNS = ("[A-Z]", "[0-9]", "[.,;:?'\"()-]", "[#*$%&<>]", "[|]", "[!]")

MIN_WORDS = 50
MIN_CHARS = 2 * MIN_WORDS - 1  # the least that so many words can have: each text past the base rules is judged
MAX_CLASS_DISTANCE = 0.2
MAX_WORD_DISTANCE = 0.3  # a text without any common word lies at 0.337 to 0.349 from the four languages of sf0.1


def _log2(x):
    return F.when(x > 0, F.log2(x)).otherwise(F.lit(0.0))


def _starts(n, shift):
    """Start of every 3-word window whose words occur in another window of the text, ascending.

    Each window is a long with hash bits above its position, so that sorting brings equal windows
    together; the position takes no more bits than the length of the text needs.
    """
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    packed = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.call_function("shiftleft", window(i), shift).bitwiseOR(i.cast("long")),
    )
    return F.when(n >= 4, F.sort_array(packed)).otherwise(F.array().cast("array<bigint>"))


def _likely(shift):
    """Positions whose window has the hash bits of another one: all that repeat, and chance matches of the hash."""
    high = lambda x: F.call_function("shiftright", x, shift)
    near = lambda x, i: (high(x) == high(F.get("packed", i - 1))) | (high(x) == high(F.get("packed", i + 1)))
    found = F.filter("packed", lambda x, i: F.coalesce(near(x, i), F.lit(False)))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), shift) - 1
    return F.transform(found, lambda x: x.bitwiseAND(mask))


def _windows():
    """The three words at each of the ``likely`` positions, equal ones together."""
    word = lambda p, i: F.get("words", p.cast("int") + i)
    window = lambda p: F.struct(word(p, 0).alias("a"), word(p, 1).alias("b"), word(p, 2).alias("c"))
    return F.sort_array(F.transform("likely", lambda p: F.struct(window(p).alias("w"), p.alias("p"))))


def _repeated():
    """Positions of ``windows`` whose words occur at another one, ascending: words decide, not hashes."""
    same = lambda x, i: (x["w"] == F.get("windows", i - 1)["w"]) | (x["w"] == F.get("windows", i + 1)["w"])
    found = F.filter("windows", lambda x, i: F.coalesce(same(x, i), F.lit(False)))
    return F.sort_array(F.transform(found, lambda x: x["p"]))


def _covered(starts):
    """Words covered by 3-word windows at the given ascending starts."""
    step = lambda acc, p: F.struct(
        (acc["n"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("n"), p.alias("last"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last"))
    return F.aggregate(starts, zero, step, lambda acc: acc["n"])


def _histograms(rows):
    """Adds ``classes`` (counts by class), ``seen`` (common words met) and ``uses`` (their counts)."""
    text = F.coalesce("text", F.lit(""))
    chars = F.length(text)
    rows = bound(rows, word_chars=F.length(F.array_join("words", "")))
    blank, high = chars - F.col("word_chars"), F.octet_length(text) - chars
    rows = bound(rows, counted=F.array(*[F.regexp_count(text, F.lit(p)) for p in PATTERNS], blank, high))
    rest = F.greatest(chars - F.aggregate("counted", F.lit(0), lambda acc, x: acc + x), F.lit(0))
    rows = bound(rows, common=F.filter(F.transform("words", F.lower), lambda w: w.isin(COMMON_WORDS)))
    rows = bound(rows, seen=F.array_distinct("common"))
    uses = F.transform("seen", lambda w: F.size("common") - F.size(F.array_remove("common", w)))
    # The empty string stands for any other word.
    return rows.withColumns({
        "classes": F.concat("counted", F.array(rest)).cast("array<bigint>"),
        "uses": F.concat(uses, F.array(F.size("words") - F.size("common"))).cast("array<bigint>"),
    }).withColumn("seen", F.concat("seen", F.array(F.lit(""))))


def references(measured: DataFrame) -> DataFrame:
    """Per language: shares of the classes and of the common words over all its measured texts.

    One small row per value of ``lang`` (null is a value), from sums that are taken before shuffling.
    """
    rows = measured.select("lang", "classes", "seen", "uses")
    number = F.transform("classes", lambda c, i: F.struct(i.cast("string").alias("key"), c.alias("uses")))
    word = F.transform(F.arrays_zip("seen", "uses"), lambda w: F.struct(
        F.concat(F.lit("="), w["seen"]).alias("key"), w["uses"].alias("uses")))
    sums = rows.select("lang", F.inline(F.concat(number, word))).groupBy("lang", "key").agg(F.sum("uses").alias("uses"))
    entry = F.struct("key", "uses")
    listed = sums.groupBy("lang").agg(F.sort_array(F.collect_list(entry)).alias("all"))
    total = lambda found: F.greatest(F.aggregate(found, F.lit(0).cast("long"), lambda acc, x: acc + x["uses"]), F.lit(1))
    listed = listed.select(
        "lang", F.filter("all", lambda x: ~x["key"].startswith("=")).alias("classes"),
        F.filter("all", lambda x: x["key"].startswith("=")).alias("words"),
    )
    return listed.select(
        F.col("lang").alias("ref_lang"),
        F.transform("classes", lambda x: x["uses"] / total(F.col("classes"))).alias("ref_classes"),
        F.map_from_entries(F.transform("words", lambda x: F.struct(
            F.substring(x["key"], 2, 1000), x["uses"] / total(F.col("words"))))).alias("ref_words"),
    )


def _distance(shares, reference):
    """Jensen-Shannon distance of two aligned arrays; what the second holds elsewhere counts too."""
    part = lambda p, q: p * _log2(2 * p / (p + q)) + q * _log2(2 * q / (p + q))
    met = F.zip_with(shares, reference, lambda p, q: F.struct(F.when(p + q > 0, part(p, q)).otherwise(0.0).alias("d"), q.alias("q")))
    add = lambda acc, x: F.struct((acc["d"] + x["d"]).alias("d"), (acc["q"] + x["q"]).alias("q"))
    zero = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("q"))
    return F.aggregate(met, zero, add, lambda acc: F.sqrt(F.greatest((acc["d"] + F.greatest(1 - acc["q"], F.lit(0.0))) / 2, F.lit(0.0))))


def measure(documents: DataFrame) -> DataFrame:
    """All rows of ``documents`` with the base counts, ``base_failed``, ``chars`` and the histograms.

    The histograms are ``classes``, and ``seen`` with ``uses``. Null, empty and blank texts have no words
    and fail the base rules. Columns of the input that are named like one of this module's are replaced.
    """
    own = ["words", "n", "shift", "packed", "likely", "windows", "starts", "lines", "word_chars", "counted", "common", "seen", "classes",
           "uses", "chars", "ref_lang", "ref_classes", "ref_words", "n_words", "n_symbols", "n_dup_lines",
           "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept"]
    rows = bound(documents.drop(*own), words=words_of("text"))
    rows = bound(rows, n=F.size("words"))
    rows = bound(rows, shift=F.length(F.bin("n")))
    rows = bound(rows, packed=_starts(F.col("n"), F.col("shift")))
    rows = bound(rows, likely=_likely(F.col("shift")))
    rows = bound(rows, windows=_windows())
    rows = bound(rows, starts=_repeated())
    text = F.coalesce("text", F.lit(""))
    worded = lambda line: F.length(F.translate(line, " \t\n\x0b\x0c\r", "")) > 0
    rows = bound(rows, lines=F.filter(F.split(text, "\n"), worded))
    rows = bound(rows, n_repeat_words=_covered(F.col("starts")))
    return _histograms(rows).withColumns({
        "n_words": F.col("n").cast("long"),
        "word_chars": F.col("word_chars").cast("long"),
        "n_symbols": (F.get("counted", F.lit(3)) + F.get("counted", F.lit(4))).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "chars": F.length(text),
        "base_failed": (F.col("n") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n")),
    }).drop("words", "packed", "likely", "windows", "starts", "lines", "n", "shift", "counted", "common")


def judge(measured: DataFrame, reference: DataFrame) -> DataFrame:
    """The rows of ``measure`` with both distances and ``kept`` in place of the histograms.

    ``kept`` is false if the base rules fail, or if a text of ``MIN_CHARS`` characters has a class
    distance above ``MAX_CLASS_DISTANCE``, or one of ``MIN_WORDS`` words a word distance above
    ``MAX_WORD_DISTANCE``. A null language is a language of its own.
    """
    rows = measured.join(reference, measured["lang"].eqNullSafe(F.col("ref_lang")), "left")
    share = lambda counts: F.transform(counts, lambda c: c / F.greatest(
        F.aggregate(counts, F.lit(0).cast("long"), lambda acc, x: acc + x), F.lit(1)))
    expected = F.transform("seen", lambda w: F.coalesce(F.element_at("ref_words", w), F.lit(0.0)))
    rows = rows.withColumns({
        "class_distance": _distance(share("classes"), F.col("ref_classes")),
        "word_distance": _distance(share("uses"), expected),
    })
    odd = (F.col("chars") >= MIN_CHARS) & (F.col("class_distance") > MAX_CLASS_DISTANCE)
    foreign = (F.col("n_words") >= MIN_WORDS) & (F.col("word_distance") > MAX_WORD_DISTANCE)
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(odd, F.lit(False)) & ~F.coalesce(foreign, F.lit(False))).drop(
        "chars", "seen", "classes", "uses", "ref_lang", "ref_classes", "ref_words")


def quality(documents: DataFrame, with_text=True) -> DataFrame:
    """The documents, with or without their text, judged by the references of the same documents.

    Texts are read once: the references are summed from the measures, which are written.
    """
    measured = measure(documents)
    measured = written(measured if with_text else measured.drop("text"), "measures")
    return judge(measured, written(references(measured), "references"))
