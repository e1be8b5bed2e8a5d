"""Lines that repeat an earlier one but for at most one word are removed.

A line is compared by its words, in lower case. Lines of fewer than `min_words` words
are compared with equal ones only, if they have `min_chars` characters, else left alone.
Equal lines meet by hash, and the earliest (by document id, then line)
stays. Two longer lines within one edit share their first words or their last ones, up to half
of the line, whichever the edit is not in; so of the distinct lines those that share
neither with another of their length, or of one word more or less, are done. The others
emit their deletion neighbourhood, the hash of the line without each of its words, on
the side where the edit may be. Lines of the same length that agree
without the word at the same place differ by a substitution, and a line that agrees
with a longer one without a word by a deletion. A group of equal variants is settled
by its earliest line, so no pairs of its members are made. Every pair that decides
something is verified on the words. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopgrid.llm.bitmaps import bitmap, may_match
from stopgrid.llm.common import text_of
from stopgrid.session import stored

MIN_WORDS = 8
#: A line of fewer words goes as well if it equals an earlier one and has so many characters.
MIN_CHARS = 40
#: A document that loses this share of its text goes as a whole, if asked for.
GONE = 0.8

_ROW = ("r1", "r2")


def _keyed(docs: DataFrame, id_col: str, text_col: str, carry: Column) -> DataFrame:
    """id, text, and a 128-bit key of both; equal rows have equal keys."""
    given = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"), carry.alias("carry"))
    return given.select("*", F.xxhash64("id", "text").alias("r1"), F.xxhash64(F.lit(1), "id", "text").alias("r2"))


def spaced(text: Column) -> Column:
    """Single blanks between words; line ends stay."""
    odd = [F.contains(text, F.lit(x)) for x in ("  ", "\t", "\r", "\f", "\x0b")]
    return F.when(odd[0] | odd[1] | odd[2] | odd[3] | odd[4], F.regexp_replace(text, "[ \\t\\x0B\\f\\r]+", " ")).otherwise(text)


def normal(text: Column) -> Column:
    """Lower case, single blanks between words; line ends stay."""
    # lowered last, as the text stands there several times
    return F.lower(spaced(text))


def n_words(line: Column) -> Column:
    """The words of a line with single blanks, those at its ends aside."""
    bare = F.trim(line)
    blanks = F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(" "), F.lit("")))
    return F.when(bare == "", 0).otherwise(blanks + 1)


def compared(line: Column, min_words: int, min_chars: int | None) -> Column:
    """Whether a line with single blanks is long enough to go if an earlier one equals it."""
    wordy = n_words(line) >= min_words
    return wordy if min_chars is None else wordy | (F.char_length(F.trim(F.lower(line))) >= min_chars)


def _lines(keyed: DataFrame) -> DataFrame:
    """The lines in normal form."""
    lines = keyed.select("id", *_ROW, F.posexplode(F.split(normal(F.col("text")), "\n", -1)).alias("no", "line"))
    return lines.withColumn("line", F.trim("line"))


#: The number of words in an end.
_END = "cast(shiftleft(1, cast(floor(log2({0})) as int) - 1) as int)"


def _with_ends(lines: DataFrame, min_words: int) -> DataFrame:
    """`lines` with k0 to k3, hashes of a line's first words and of its last, a power of two
    of them, at most half: as of a line of its length, and as of one of a word less. They
    mean nothing for lines of fewer than `min_words` words."""
    long = F.col("n") >= min_words
    sized = lines.withColumns({name: F.when(long, F.expr(_END.format(n))) for name, n in (("e", "n"), ("e_less", "(n - 1)"))})
    first, last = "xxhash64(substring_index(line, ' ', {0}))", "xxhash64(substring_index(line, ' ', -{0}))"
    own = sized.withColumns({"first": F.expr(first.format("e")), "last": F.expr(last.format("e"))})
    # the two lengths have ends of equal size but where a power of two is between them
    same = F.col("e") == F.col("e_less")
    less = [F.when(same, F.col(k)).otherwise(F.expr(end.format("e_less"))) for k, end in (("first", first), ("last", last))]
    return own.select(
        *lines.columns,
        F.xxhash64("n", F.lit(0), "first").alias("k0"),
        F.xxhash64("n", F.lit(1), "last").alias("k1"),
        F.xxhash64(F.col("n") - 1, F.lit(0), less[0]).alias("k2"),
        F.xxhash64(F.col("n") - 1, F.lit(1), less[1]).alias("k3"),
    )


def _distinct_lines(keyed: DataFrame, min_words: int, min_chars: int | None, short: bool) -> DataFrame:
    """(h1, h2, first, n, ends): each distinct line that is compared with its earliest place.

    With `short` the others come too, blank ones aside, and a column `judged` tells them apart.
    """
    lines = _lines(keyed).withColumn("n", n_words(F.col("line")))
    judged = compared(F.col("line"), min_words, min_chars)
    if short:
        lines = lines.withColumn("judged", judged)
    lines = _with_ends(lines.filter(F.col("n") >= 1 if short else judged), min_words)
    place, told, keys = ["id", "no", *_ROW], ["n", "judged"] if short else ["n"], [f"k{i}" for i in range(4)]
    ends = [F.col(k) for k in keys]
    if short or min_chars is not None:
        ends = [F.when(F.col("n") >= min_words, end) for end in ends]
    # equal lines agree in all that follows the place, so the least of these is of the earliest
    found = (
        lines.select(
            F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), *place, *told,
            *(end.alias(k) for k, end in zip(keys, ends)),
        )
        .groupBy("h1", "h2")
        .agg(F.min(F.struct(*place, *told, *keys)).alias("line"))
    )
    line = {c: F.col(f"line.{c}") for c in (*place, *told, *keys)}
    return stored(
        found.select(
            "h1", "h2", F.struct(*(line[c].alias(c) for c in place)).alias("first"),
            *(line[c].alias(c) for c in told), F.array(*(line[k] for k in keys)).alias("ends"),
        ),
        "lines",
    )


#: What a candidate line may have: an equal end (first, last) with a line of its length, with a shorter, with a longer one.
_FLAGS = ("same0", "same1", "shorter0", "shorter1", "longer")


def _candidates(lines: DataFrame, min_words: int) -> DataFrame:
    """(ord, h1, h2, n, no, r1, r2, flags): the lines that share an end, numbered from the earliest on.

    Ends 0 and 1 are those of the line, 2 and 3 those it has beside a line of one word less.
    """
    ends = lines.filter(F.col("n") >= min_words).select("h1", "h2", F.posexplode("ends").alias("which", "end"))
    own = F.count(F.when(F.col("which") < 2, 1))
    counts = ends.groupBy("end").agg(own.alias("own"), F.count(F.when(F.col("which") >= 2, 1)).alias("beside"))
    shared = stored(counts.filter("own > 1 or (own > 0 and beside > 0)"), "shared-ends")
    likely = may_match(ends, F.col("end"), bitmap(shared, F.col("end"))).join(shared, "end")
    which, many = F.col("which"), F.col("own") > 1
    flags = [(which == 0) & many, (which == 1) & many, which == 2, which == 3, (which < 2) & (F.col("beside") > 0)]
    names = likely.groupBy("h1", "h2").agg(*(F.max(f).alias(n) for f, n in zip(flags, _FLAGS)))
    anyway = F.col("same0") | F.col("same1") | F.col("shorter0") | F.col("shorter1") | F.col("longer")
    names = stored(names.filter(anyway), "sharing-lines")
    found = may_match(lines, F.col("h1"), bitmap(names, F.col("h1"))).join(names, ["h1", "h2"])
    order = ["id", "no", *_ROW]
    return stored(
        found.select("h1", "h2", "n", "first.*", *_FLAGS)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.monotonically_increasing_id().alias("ord"), "*"),
        "candidate-lines",
    )


def _texts(keyed: DataFrame, candidates: DataFrame) -> DataFrame:
    """(ord, words, flags): what the candidate lines say, read again from their earliest places."""
    place = F.xxhash64(*_ROW, "no")
    raw = keyed.select(*_ROW, F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))
    lines = may_match(raw, place, bitmap(candidates, place))
    found = lines.join(candidates.select("ord", *_ROW, "no", *_FLAGS), [*_ROW, "no"])
    # a document that is there twice gives its lines twice
    line = F.trim(normal(F.col("line")))
    once = found.groupBy("ord").agg(F.first(line).alias("line"), *(F.first(f).alias(f) for f in _FLAGS))
    return stored(once.select("ord", F.split("line", " ").alias("words"), *_FLAGS), "candidate-texts")


def _variants(texts: DataFrame) -> DataFrame:
    """(k1, k2, kind, ord): hashes of the lines and of all variants without one word.

    The hash of a sequence is the exclusive-or of the hashes of (word, place), so those
    of all variants come from running ones: the words before the one left out keep
    their places, those behind move up. Kinds: 0 a variant beside its place, 1 a variant,
    2 a whole line.
    """
    # dealt as lines, not as words with their hashes
    words = texts.repartition("ord").select("ord", *_FLAGS, F.size("words").alias("n"), F.posexplode("words").alias("i", "w"))
    here = [F.xxhash64("w", "i"), F.xxhash64(F.lit(1), "w", "i")]
    moved = [F.xxhash64("w", F.col("i") - 1), F.xxhash64(F.lit(1), "w", F.col("i") - 1)]
    line = Window.partitionBy("ord").orderBy("i")
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hashed = words.select(
        "ord", *_FLAGS, "n", "i", *(h.alias(f"h{k}") for k, h in enumerate(here)), *(m.alias(f"m{k}") for k, m in enumerate(moved))
    )
    run = hashed.select(
        "ord", *_FLAGS, "n", "i", "h0", "h1",
        *(F.bit_xor(f"h{k}").over(upto).alias(f"whole{k}") for k in (0, 1)),
        *(F.bit_xor(f"m{k}").over(upto).alias(f"moved{k}") for k in (0, 1)),
        *(F.bit_xor(f"m{k}").over(whole).alias(f"all{k}") for k in (0, 1)),
    )
    # whole and h: the words before this one, all and moved: those behind it
    without = [F.col(f"whole{k}").bitwiseXOR(F.col(f"h{k}")).bitwiseXOR(F.col(f"all{k}")).bitwiseXOR(F.col(f"moved{k}")) for k in (0, 1)]

    def row(kind: int, *of) -> Column:
        keys = [F.xxhash64(F.lit(k), F.lit(min(kind, 1)), *(x[k] if isinstance(x, list) else x for x in of)) for k in (0, 1)]
        return F.struct(*(key.alias(f"k{k}") for k, key in enumerate(keys)), F.lit(kind).alias("kind"))

    def behind(level: str) -> Column:
        """Whether the edit here leaves the first words as they are, else it leaves the last."""
        return F.expr(f"i >= {_END.format(level)}")

    rows = F.array(
        F.when(F.when(behind("n"), F.col("same0")).otherwise(F.col("same1")), row(0, F.col("n"), F.col("i"), without)),
        F.when(
            F.when(behind("(n - 1)"), F.col("shorter0")).otherwise(F.col("shorter1")), row(1, F.col("n") - 1, without)
        ),
        F.when(F.col("longer") & (F.col("i") == F.col("n") - 1), row(2, F.col("n"), [F.col("whole0"), F.col("whole1")])),
    )
    found = run.select("ord", F.explode(rows).alias("r")).filter("r is not null")
    return stored(found.select("ord", F.col("r.k0").alias("k1"), F.col("r.k1").alias("k2"), "r.kind"), "variants")


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words are equal but for one word changed, left out or put in."""

    def same_ahead(x: Column, y: Column) -> Column:
        differs = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(False))
        return F.when(differs == 0, F.greatest(F.size(x), F.size(y)).cast("long")).otherwise(differs - 1)

    longest = F.greatest(F.size(a), F.size(b))
    ahead, behind = same_ahead(a, b), same_ahead(F.reverse(a), F.reverse(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (ahead + behind >= longest - 1)


def _near(candidates: DataFrame, texts: DataFrame) -> DataFrame:
    """(h1, h2) of the distinct lines within one edit of an earlier one."""
    variants = _variants(texts)
    first = [F.min(F.when(F.col("kind") == k, F.col("ord"))).alias(f"first{k}") for k in (0, 1, 2)]
    groups = variants.groupBy("k1", "k2").agg(F.count("*").alias("n"), *first).filter("n > 1")
    groups = stored(groups.filter("first0 is not null or (first1 is not null and first2 is not null)").drop("n"), "variant-groups")
    likely = may_match(variants, F.col("k1"), bitmap(groups, F.col("k1")))
    keeper = F.when(F.col("kind") == 0, F.col("first0")).when(F.col("kind") == 1, F.col("first2")).otherwise(F.col("first1"))
    pairs = likely.join(groups, ["k1", "k2"]).select("ord", keeper.alias("keeper")).filter("keeper < ord").distinct()
    pairs = stored(pairs, "line-pairs")
    own = texts.select("ord", F.col("words").alias("own"))
    kept = texts.select(F.col("ord").alias("keeper"), F.col("words").alias("kept"))
    verified = pairs.join(own, "ord").join(kept, "keeper").filter(within_one_edit(F.col("own"), F.col("kept")))
    return stored(candidates.join(verified.select("ord").distinct(), "ord", "left_semi").select("h1", "h2"), "near-lines")


def _kept_lines(keyed: DataFrame, min_words: int, min_chars: int | None, short: bool) -> DataFrame:
    """(r1, r2, kept): per document the numbers of its compared lines that stay.

    Only documents with such a line are there; with `short` also those with another
    line that is not blank and equals no earlier one.
    """
    lines = _distinct_lines(keyed, min_words, min_chars, short)
    candidates = _candidates(lines, min_words)
    near = _near(candidates, _texts(keyed, candidates))
    told = ["judged"] if short else []
    stay = lines.select("h1", "h2", "first", *told).join(near, ["h1", "h2"], "left_anti").select("first.*", *told)
    no = F.when(F.col("judged"), F.col("no")) if short else F.col("no")
    return stored(stay.groupBy(*_ROW).agg(F.collect_set(no).alias("kept")), "kept-lines")


def _judged(
    docs: DataFrame, min_words: int, min_chars: int | None, id_col: str, text_col: str, carry: Column, short: bool = False
) -> DataFrame:
    """(id, carry, bytes, n_lines, n_dropped, own, text) per row of `docs`: its lines that stay.

    `own` says whether one of them is the earliest of its kind, with `short` among all that are not blank.
    """
    keyed = _keyed(docs, id_col, text_col, carry)
    kept = _kept_lines(keyed.drop("carry"), min_words, min_chars, short)
    # the texts are not sorted for this join; the numbers of a partition's lines fit into memory
    lines = keyed.join(kept.hint("shuffle_hash"), [*_ROW], "left").select(
        "id", "carry", F.octet_length("text").alias("bytes"), F.split("text", "\n", -1).alias("lines"),
        F.col("kept").isNotNull().alias("own"), F.coalesce("kept", F.array().cast("array<int>")).alias("kept"),
    )

    def stays(line: Column, i: Column) -> Column:
        return F.array_contains("kept", i) | ~compared(spaced(line), min_words, min_chars)

    told = lines.select("id", "carry", "bytes", "own", F.size("lines").alias("n"), F.filter("lines", stays).alias("stay"))
    return told.select(
        "id", "carry", "bytes",
        F.col("n").cast("long").alias("n_lines"),
        (F.col("n") - F.size("stay")).cast("long").alias("n_dropped"),
        "own",
        F.array_join("stay", "\n").alias("text"),
    )


def dedup_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int | None = MIN_CHARS,
) -> DataFrame:
    """(id, n_lines, n_dropped, text): one row per row of `docs`.

    A line goes if an earlier one, by document id and then line number, equals it or
    is within one word of it, whether or not that one stays itself. Lines of fewer
    than `min_words` words go only if they equal one and have `min_chars` characters;
    with None for these they all stay. Null ids come first; null texts count as empty, and an empty text is one empty line. Rows with
    the same id and text are one and the same document: their lines do not count as
    repeats of each other, and all the rows come back alike. Rows with the same id
    and different texts go by line number, then by a hash. Other columns are ignored;
    an empty table gives none.
    """
    return _judged(docs, min_words, min_chars, id_col, text_col, F.lit(None)).drop("carry", "bytes", "own")


def keep_new_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, gone: float | None = GONE, min_chars: int | None = MIN_CHARS
) -> DataFrame:
    """`docs` with only the lines that stay, and without documents that lost `gone` of their text.

    With None for `gone` a document goes only if it lost lines and has none of its own
    left: what remains is blank or equals an earlier line. Columns are as they were,
    n_chars in line with the text if there. Documents that lose nothing, empty ones and
    those with a null text among them, are untouched.
    """
    others = [c for c in docs.columns if c != "text"]
    carry = F.struct(F.col("text").isNull().alias("text"), *(F.col(f"`{c}`") for c in others))
    result = _judged(docs, min_words, min_chars, "doc_id", "text", carry, short=gone is None)
    enough = F.col("own") if gone is None else F.octet_length("text") > F.lit(1 - gone) * F.col("bytes")
    left = result.filter((F.col("n_dropped") == 0) | enough)
    columns = {c: F.col(f"carry.`{c}`") for c in docs.columns}
    columns["text"] = F.when(~columns["text"], F.col("text"))
    if "n_chars" in columns:
        n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("n_dropped") > 0, n_chars).otherwise(columns["n_chars"])
    return left.select(*(column.alias(name) for name, column in columns.items()))
