"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so that a question asked
with other values has the same canonical words. Windows of five canonical words
are hash-joined with those of the benchmark; a document that holds four fifths
of an item's windows is a candidate. Its windows are then laid beside the
item's: a value of the item must always stand for one value of the document, and
the other way round, within one occurrence of the item. Windows that break this are
taken away, and the item is found where an occurrence still has four fifths of
its windows.

Only DataFrame functions. Canonical words: a number is a run of digits with
single points or commas inside; a unit is one of `UNITS` after a number. Any
capitalised word may be a name: a window of a document is looked up in lower
case as it is written, and with all its capitalised words as names; a window of
an item is filed under each choice of its capitalised words as names. So a
window's hashes depend on its own words alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, let, stored

WINDOW, SHARE = 5, 0.8
#: Bytes of the benchmark's window hashes (ROW_BYTES each, three longs and a hash table's share) up to which they are
#: broadcast; more are joined by a shuffle. All other joins are left to Spark's sizes.
BROADCAST_BYTES, ROW_BYTES = 16 << 20, 48
#: What a number, a name and a unit become.
PLACEHOLDERS = ("<num>", "<name>", "<unit>")

#: Written forms of units.
UNITS = ("km|cm|mm|m|mi|ft|in|kg|g|mg|lb|lbs|oz|l|ml|s|ms|min|h|hr|hrs|kmh|mph|hz|w|kw|kwh|v|a|j|kj|n|pa|eur|usd|"
         "percent|dollars|dollar|euros|euro|cents|pounds|meters|metres|meter|metre|kilometers|kilometres|miles|mile|"
         "feet|foot|inches|inch|yards|grams|kilograms|liters|litres|hours|hour|minutes|minute|seconds|second|days|day|"
         "weeks|week|months|month|years|year|degrees")
UNIT = "\x02"
#: What words are made of: letters, digits, marks, and all characters beyond Latin punctuation, general punctuation
#: and the CJK marks.
WORD_CHARS = r"A-Za-z0-9_<>\x02À-῿⁰-⿿぀-\x{10FFFF}"
BREAK = rf"[^{WORD_CHARS}]+"
#: A word that begins with a capital letter.
CAPITALISED = rf"(?<![{WORD_CHARS}])\p{{Lu}}[{WORD_CHARS}]*"
DIGIT = "[0-9]"


def marked(text: Column) -> Column:
    """The text with decimals joined and units marked; its words are then the
    runs of letters, digits and marks. Null counts as empty."""
    def numbers(t: Column) -> Column:
        joined = F.regexp_replace(t, r"([0-9])[.,]([0-9])", "$1_$2")
        return F.when(F.rlike(t, F.lit(DIGIT)), F.regexp_replace(joined, rf"([0-9]) ?(?i)({UNITS})\b", f"$1 {UNIT}$2")).otherwise(t)

    return let(F.coalesce(text, F.lit("")), numbers)


def surface_words(m: Column) -> Column:
    """Words of a marked text as they are written."""
    return F.array_remove(F.split(m, BREAK), "")


def canonical_words(m: Column) -> Column:
    """Words of a marked text in lower case, with placeholders; as many as `surface_words`."""
    def placed(mark, pattern: str, name: str):
        return lambda t: F.when(mark(t), F.regexp_replace(t, pattern, name)).otherwise(t)

    t = let(m, placed(lambda t: F.contains(t, F.lit(UNIT)), rf"{UNIT}[\p{{L}}]+", "<unit>"))
    t = let(F.lower(t), placed(lambda t: F.rlike(t, F.lit(DIGIT)), r"[0-9][0-9_]*", "<num>"))
    return F.array_remove(F.split(t, BREAK), "")


def named_words(m: Column) -> Column:
    """Canonical words with each capitalised word as a name."""
    return canonical_words(F.regexp_replace(m, CAPITALISED, "<name>"))


def _starts(words: Column) -> Column:
    """Places where windows begin, from 0; fewer words: one window; none: no window."""
    return F.when(F.size(words) > 0, F.sequence(F.lit(0), F.greatest(F.size(words) - WINDOW, F.lit(0)))
                  ).otherwise(F.array().cast("array<int>"))


def _window(words: Column, i: Column) -> list[Column]:
    """The words of a window one by one (`slice` would copy all words for each); null beyond the end."""
    return [F.get(words, i + k) for k in range(WINDOW)]


def _window_hash(hashed: Column, i: Column) -> Column:
    return F.xxhash64(*_window(hashed, i))


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _named_starts(x: Column) -> Column:
    """Places of the windows that hold a capitalised word."""
    last = F.greatest(F.size(x["a"]) - WINDOW, F.lit(0))
    held = F.filter(F.sequence(F.lit(0), F.size(x["a"]) - 1), lambda i: F.get(x["a"], i) != F.get(x["b"], i))
    near = F.flatten(F.transform(held, lambda i: F.sequence(F.least(F.greatest(i - (WINDOW - 1), F.lit(0)), last), F.least(i, last))))
    return F.when(F.size(x["a"]) > 0, F.array_distinct(near)).otherwise(F.array().cast("array<int>"))


def _short_starts(words: Column, n: int, plain) -> Column:
    """Places in a text of more than n words of the windows of n words that
    hold a word that is no placeholder."""
    last = F.size(words) - n
    held = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.exists(
        F.array(*[F.get(words, i + k) for k in range(n)]), plain))
    return F.when(last > 0, held).otherwise(F.array().cast("array<int>"))


def window_hashes(m: Column, short: tuple[int, ...] = ()) -> Column:
    """Hashes of all windows of a marked text, as written and with names; also
    of its windows of the lengths `short`, those of benchmark items of fewer
    words than a window has."""
    both = let(m, lambda t: F.struct(_word_hashes(canonical_words(t)).alias("a"), _word_hashes(named_words(t)).alias("b")))

    def plain(h: Column) -> Column:
        return ~h.isin(*[F.xxhash64(F.lit(p)) for p in PLACEHOLDERS])

    def shorter(words: Column, n: int) -> Column:
        return F.transform(_short_starts(words, n, plain), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))

    return let(both, lambda x: F.array_distinct(F.concat(
        F.transform(_starts(x["a"]), lambda i: _window_hash(x["a"], i)),
        F.transform(_named_starts(x), lambda i: _window_hash(x["b"], i)),
        *[shorter(x[form], n) for n in short for form in ("a", "b")])))


def windows(m: Column, short: tuple[int, ...] = ()) -> Column:
    """All windows of a marked text: (at, c canonical words, b with names, s
    surface words in lower case); also those of the lengths `short`."""
    words = let(m, lambda t: F.struct(canonical_words(t).alias("c"), named_words(t).alias("b"), surface_words(t).alias("s")))
    own = lambda x, i, n: F.array_compact(F.array(*[F.get(x, i + k) for k in range(n)]))

    def cut(x: Column, starts: Column, n: int) -> Column:
        return F.transform(starts, lambda i: F.struct(
            i.alias("at"), own(x["c"], i, n).alias("c"), own(x["b"], i, n).alias("b"),
            F.transform(own(x["s"], i, n), lambda w: F.lower(w)).alias("s")))

    plain = lambda w: ~w.isin(*PLACEHOLDERS)
    return let(words, lambda x: F.concat(cut(x, _starts(x["c"]), WINDOW),
                                         *[cut(x, _short_starts(x["c"], n, plain), n) for n in short]))


def _keyed(rows: DataFrame, id_col: str, text_col: str, names: tuple[str, str]) -> DataFrame:
    """(id, key, text): key is the text's hash, which tells apart rows of one id."""
    return rows.select(F.col(id_col).alias(names[0]), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias(names[1]),
                       F.col(text_col).alias("text"))


def _windows_of(rows: DataFrame, *keys: str, forms: int = 1, short: tuple[int, ...] = ()) -> DataFrame:
    """Windows (*keys, own, h, at, c, s): own is the hash as written, h that of
    the form c. `forms` 1: as written and with all names; 2: each choice of names."""
    w = rows.select(*keys, F.explode(windows(marked(F.col("text")), short)).alias("w")).select(*keys, "w.*")
    if forms == 1:
        w = w.withColumn("form", F.explode(F.array_distinct(F.array("c", "b"))))
    else:
        w = w.withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit((1 << WINDOW) - 1)))).withColumn(
            "form", F.transform("c", lambda x, k: F.when(F.getbit("mask", k) == 1, F.get("b", k)).otherwise(x)))
        w = w.drop("mask").distinct()
    hashed = lambda c: _window_hash(_word_hashes(F.col(c)), F.lit(0))
    return w.select(*keys, hashed("c").alias("own"), hashed("form").alias("h"), "at", F.col("form").alias("c"), "s")


def _occurrences(laid: DataFrame, pair: list[str]) -> DataFrame:
    """Each laid window in the alignments it can belong to: (level, occurrence).

    0: windows of one shift of the item against the document; 1: of shifts that
    follow each other by at most half the item's windows, so words put in or
    left out do not end it; 2: the whole document, for parts far from each other.
    """
    laid = laid.withColumn("shift", F.col("at") - F.col("i_at"))
    order = Window.partitionBy(*pair).orderBy("shift")
    jumps = F.col("shift") - F.lag("shift").over(order) > F.greatest(F.col("n_windows") / 2, F.lit(1))
    parts = laid.select(*pair, "n_windows", "shift").distinct().withColumn("new", F.coalesce(jumps, F.lit(False)).cast("int"))
    parts = parts.withColumn("part", F.sum("new").over(order).cast("int"))
    shifts = [F.col("shift"), F.col("part"), F.lit(0)]
    levels = F.array(*[F.struct(F.lit(i).alias("level"), x.alias("occurrence")) for i, x in enumerate(shifts)])
    parts = parts.select(*[F.col(k).alias(f"p_{k}") for k in [*pair, "shift"]], F.explode(levels).alias("o"))
    same = [F.col(k).eqNullSafe(F.col(f"p_{k}")) for k in [*pair, "shift"]]
    return laid.join(parts, same).select(*pair, "n_windows", "own", "h", "at", "i_at", "slots", "o.level", "o.occurrence")


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for every document and benchmark item it holds: (doc_id,
    doc_key, item_id, n_windows, n_matched, share, reparameterised).

    n_windows and n_matched count different windows of the item in lower case;
    of the
    occurrence with most; reparameterised: some slot of it has another value than in the item. Rows that
    repeat both id and text give one result; ids may be null. Texts and items
    that are null or without words hold nothing; an item of fewer than five
    words has one window, itself, which is sought in every document, in longer ones
    where it holds a word that is no placeholder. Other columns are ignored.
    """
    items = stored(_keyed(benchmark, item_col, item_text_col, ("item_id", "item_key")).distinct(), "benchmark")
    item_windows = stored(_windows_of(items, "item_id", "item_key", forms=2), "benchmark-windows")
    item_keys = ["item_id", "item_key"]
    sizes = item_windows.groupBy(*item_keys).agg(F.count_distinct("own").alias("n_windows"))
    index = stored(item_windows.select("h", "own", F.xxhash64(*item_keys).alias("item")).distinct(), "benchmark-index")
    near = F.broadcast if index.count() * ROW_BYTES <= BROADCAST_BYTES else lambda x: x
    # the lengths, four at most, of items shorter than a window
    lengths = item_windows.where(F.size("c") < WINDOW).select(F.size("c").alias("n")).distinct().collect()
    short = tuple(sorted(r.n for r in lengths))

    keyed = _keyed(docs, id_col, text_col, ("doc_id", "doc_key"))
    hashes = keyed.select("doc_id", "doc_key", F.explode(window_hashes(marked(F.col("text")), short)).alias("h"))
    counted = (hashes.join(near(index), "h").groupBy("doc_id", "doc_key", "item")
               # rows that repeat a document repeat its windows
               .agg(F.count_distinct("own").alias("n")))
    sized = sizes.withColumn("item", F.xxhash64(*item_keys))
    candidates = stored(counted.join(sized, "item").where(F.col("n") >= share * F.col("n_windows"))
                        .select(F.col("doc_id").alias("c_id"), F.col("doc_key").alias("c_key"), *item_keys, "n_windows"),
                        "leak-candidates")

    wanted = candidates.select("c_id", "c_key").distinct()
    found = (keyed.join(wanted, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("doc_key") == F.col("c_key")), "left_semi")
             .distinct())
    # only windows that an item has are shuffled with their words
    doc_windows = (_windows_of(found, "doc_id", "doc_key", short=short).drop("own")
                   .join(near(index.select("h").distinct()), "h", "left_semi"))
    pair = ["doc_id", "doc_key", "item_id", "item_key"]
    beside = item_windows.select(*item_keys, "own", "h", F.col("at").alias("i_at"), F.col("c").alias("i_c"), F.col("s").alias("i_s"))
    laid = doc_windows.join(beside, "h").where("c = i_c")
    laid = stored(laid.join(candidates.withColumnsRenamed({"item_id": "c_item", "item_key": "c_item_key"}),
                            F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("doc_key") == F.col("c_key"))
                            & F.col("item_id").eqNullSafe(F.col("c_item")) & (F.col("item_key") == F.col("c_item_key")))
                  .select(*pair, "n_windows", "own", "h", "at", "i_at",
                          F.filter(F.arrays_zip("c", F.col("i_s").alias("i"), F.col("s").alias("d")),
                                   lambda x: x["c"].isin(*PLACEHOLDERS)).alias("slots")), "leak-windows")
    laid = stored(_occurrences(laid, pair), "leak-occurrences")
    by_pair, pair = pair, [*pair, "level", "occurrence"]
    slots = laid.select(*pair, "h", "at", "i_at", F.explode("slots").alias("x")).select(
        *pair, "h", "at", "i_at", F.col("x.c").alias("kind"), F.col("x.i").alias("i"), F.col("x.d").alias("d"))
    counts = slots.groupBy(*pair, "kind", "i", "d").agg(F.count("*").alias("n"))
    # the value that stands most often for another; equal values first, then the smaller
    best = F.struct("n", (F.col("i") == F.col("d")).alias("same"), F.col("d").alias("v"), F.col("i").alias("w"))
    by_item = counts.groupBy(*pair, "kind", "i").agg(F.max(best).alias("b")).select(*pair, "kind", "i", F.col("b.v").alias("d"))
    by_doc = counts.groupBy(*pair, "kind", "d").agg(F.max(best).alias("b")).select(*pair, "kind", F.col("b.w").alias("i"), "d")

    slot = [*pair, "kind", "i", "d"]
    kept = by_item.intersect(by_doc.select(*by_item.columns)).alias("kept")
    s = slots.alias("s")
    on = [F.col(f"s.{k}").eqNullSafe(F.col(f"kept.{k}")) for k in slot]
    broken = s.join(kept, on, "left_anti").select(*[F.col(f"s.{k}") for k in [*pair, "h", "at", "i_at"]]).distinct().alias("broken")
    place = [F.col(f"l.{k}").eqNullSafe(F.col(f"broken.{k}")) for k in [*pair, "h", "at", "i_at"]]
    whole = laid.alias("l").join(broken, place, "left_anti")
    changed = F.exists("slots", lambda x: x["i"] != x["d"])
    each = (whole.groupBy(*pair, "n_windows")
            .agg(F.count_distinct("own").alias("n_matched"), F.max(changed).alias("reparameterised")))
    best_one = F.max(F.struct("n_matched", (~F.col("reparameterised")).alias("same"))).alias("o")
    return (each.groupBy(*by_pair, "n_windows").agg(best_one)
            .select("doc_id", "doc_key", "item_id", "n_windows", F.col("o.n_matched").alias("n_matched"),
                    (F.col("o.n_matched") / F.col("n_windows")).alias("share"), (~F.col("o.same")).alias("reparameterised"))
            .where(F.col("n_matched") >= share * F.col("n_windows")))


def clean(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns."""
    leak_id, leak_key = fresh("leak_id", docs), fresh("leak_key", docs)
    found = stored(leaks(docs, benchmark, share, id_col, text_col).select(
        F.col("doc_id").alias(leak_id), F.col("doc_key").alias(leak_key)).distinct(), "leaks")
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.join(found, F.col(id_col).eqNullSafe(F.col(leak_id)) & (key == F.col(leak_key)), "left_anti")
