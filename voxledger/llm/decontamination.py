"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, names and units become typed placeholders, so a question asked again
with other parameters has the same template. Windows of the template are
hash-joined with those of the benchmark; texts with enough of them are looked
at again, and only windows whose slots are filled consistently count: within
one occurrence every value of the item stands for one value of the text. Two
values of the item may meet in one of the text, as new parameters may be equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import SPACE, checkpointed, of_ids, query, stored, table, text_of

WINDOW = 8
LEAST_WORDS = 5  # shorter items have no typed window, only their own words
LEAST_LITERAL = 4  # words of a typed window that are no slots
ENOUGH = 6  # windows that make a hit: thirteen words in a row
SHARE = 0.5  # or this share of the item's windows, for short items
BROADCAST_ROWS = 1_000_000  # windows of the benchmark that are sent to all tasks

NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"
# Units of measure and currency.
UNITS = ("mm cm dm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t oz lb lbs pound pounds ml cl l liter liters litre "
         "litres s sec second seconds min minute minutes h hour hours day days week weeks month months year years kb mb gb tb hz khz mhz "
         "ghz w kw v a c f k mph kmh usd eur gbp dollar dollars euro euros cent cents percent %").split()
IS_NUMBER = r"\A(?:[$€£+\-]?\d+[\d/:\-]*[%a-z]{0,2}|\x01)\z"
IS_NAME = r"\A\p{Lu}\p{Ll}[\p{L}'’\-]*\z"


def words(text: Column) -> Column:
    """The words of a text without punctuation marks, in their own case."""
    t = F.regexp_replace(text, r"[.,;:!?\"()\[\]{}«»¿¡]+", "")
    for c in SPACE[1:]:  # then one plain split is enough
        t = F.replace(t, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(t, " "), "")


def slot_of(word: Column, before: Column) -> Column:
    """The placeholder of a number, a capitalised word or a unit behind a number, else null.

    Byte order tells by the first character which pattern is tried at all.
    """
    def number(w: Column) -> Column:
        return ((w < ":") | w.startswith("£") | w.startswith("€")) & w.rlike(IS_NUMBER)  # signs and digits come before the colon

    unit = F.when(word.isin(UNITS) & number(before), UNIT)
    name = (((word >= "A") & (word < "[")) | (word >= "À")) & word.rlike(IS_NAME)
    return F.when((word >= "a") & (word < "{"), unit).when(number(word), NUMBER).when(name, NAME).otherwise(unit)


def window_hashes(hashes: str, length: int) -> Column:
    """The hash of every window of ``length`` words, from an array of word hashes."""
    n = F.size(hashes) - length + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(hashes, i, length)))).otherwise(
        F.array().cast("array<bigint>"))


def tokenised(rows: DataFrame, text: str) -> DataFrame:
    """Adds the lower-cased words ``_w`` and their template ``_t``, with the hashes ``_p`` and ``_h``, from one split.

    A word that is no slot has the same hash in both, so has a window without slots.
    """
    cut = rows.withColumn("_o", words(text_of(text)))
    cut = cut.withColumn("_k", F.transform("_o", lambda w, i: slot_of(w, F.get("_o", i - 1)))).withColumn(
        "_p", F.transform("_o", lambda w: F.xxhash64(F.lower(w))))
    return cut.withColumn("_h", F.zip_with("_k", "_p", lambda k, p: F.when(k.isNotNull(), F.xxhash64(k)).otherwise(p))).withColumn(
        "_w", F.transform("_o", lambda w: F.lower(w))).withColumn("_t", F.zip_with("_k", "_w", lambda k, w: F.coalesce(k, w)))


def text_windows(rows: DataFrame, lengths: list[int], typed: set[int]) -> DataFrame:
    """(id, hash) of all windows of ``lengths`` words, plain ones and, for ``typed`` lengths, those with slots.

    The hashes are laid side by side, shifted by one word each, and hashed as
    columns: the same numbers as ``window_hashes`` without a slice per window.
    """
    reach = range(max(lengths))
    names = [f"{c}{j}" for c in ("_p", "_h") for j in reach]
    side = F.arrays_zip(*[F.slice(c, j + 1, F.size(c)) for c in ("_p", "_h") for j in reach])  # null behind the end
    wide = rows.select("id", F.inline(side).alias(*names))
    keys = []
    for n in lengths:
        mine, theirs = (F.xxhash64(*[f"{c}{j}" for j in range(n)]) for c in ("_p", "_h"))
        whole = F.col(f"_p{n - 1}").isNotNull()
        keys += [F.when(whole, mine)] + ([F.when(whole & (mine != theirs), theirs)] if n in typed else [])
    return wide.select("id", F.explode(F.array(*keys)).alias("hash")).where("hash is not null")


def is_slot(word: Column) -> Column:
    return word.isin(NUMBER, NAME, UNIT)


def item_windows(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, ipos, length, hash, slots, typed, need, need_any) of every window of the benchmark.

    A window is typed if it has enough literal words, and is its plain
    lower-cased words if it has slots or is not typed. ``slots`` are the
    values at the slots of typed windows, null elsewhere. Items of fewer than
    ``WINDOW`` words are one window. ``need`` typed windows make a hit (null
    if the item has none), or ``need_any`` of both kinds.
    """
    rows = tokenised(items.select(F.col(item).alias("item"), F.col(text).alias("_text")), "_text").where(F.size("_t") > 0)
    length = F.least(F.size("_t"), F.lit(WINDOW))
    at = F.explode(F.sequence(F.lit(1), F.size("_t") - length + 1))
    part = lambda c: F.slice(c, F.col("ipos"), F.col("length"))
    cut = rows.select("item", length.alias("length"), at.alias("ipos"), "_t", "_w", "_h", "_p").select(
        "item", "ipos", "length", F.xxhash64(part("_h")).alias("hash"), F.xxhash64(part("_p")).alias("plain"), part("_t").alias("t"), part("_w").alias("w"))
    literal = F.size(F.filter("t", lambda x: ~is_slot(x)))
    telling = (F.col("length") >= LEAST_WORDS) & (literal >= LEAST_LITERAL)
    typed = F.struct(F.col("hash"), F.zip_with("t", "w", lambda a, b: F.when(is_slot(a), b)).alias("slots"), F.lit(True).alias("typed"))
    whole = F.struct(F.col("plain").alias("hash"), F.transform("t", lambda a: F.lit(None).cast("string")).alias("slots"), F.lit(False).alias("typed"))
    kinds = F.when(~telling, F.array(whole)).when(literal < F.col("length"), F.array(typed, whole)).otherwise(F.array(typed))
    cut = cut.select("item", "ipos", "length", F.explode(kinds).alias("s")).select("item", "ipos", "length", "s.*")
    share = lambda n: F.least(F.lit(ENOUGH), F.ceil(n * SHARE)).cast("int")
    n_typed = F.count_if("typed")
    total = cut.groupBy("item").agg(F.when(n_typed > 0, share(n_typed)).alias("need"), share(F.count_distinct("ipos")).alias("need_any"))
    return cut.join(total, "item")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per input row: the id, ``contaminated``, ``item_ids``, ``n_windows`` and ``reparameterised``.

    ``item_ids`` are the benchmark items of which enough windows recur with
    consistent slots, or word by word in any case, in order; ``n_windows`` counts these windows;
    ``reparameterised`` says that a slot of a hit has another value than in
    the item. Items of less than ``LEAST_WORDS`` words, and windows with fewer
    than ``LEAST_LITERAL`` literal words, hit only as their own words in any
    case; so an item of one word hits every text that has it. Null and empty
    texts hit nothing, nor do items without a word. Rows that repeat an id are judged as one text. A
    null id hits nothing. Empty tables give an empty result or no hits; other
    columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    bench = checkpointed(item_windows(items, item_col, item_text))
    shape = bench.agg(F.count(F.lit(1)).alias("n"), F.collect_set("length").alias("lengths"), F.collect_set(F.when(F.col("typed"), F.col("length"))).alias("typed")).first()  # at most eight lengths
    few = lambda df: F.broadcast(df) if shape.n <= BROADCAST_ROWS else df  # noqa: E731  beyond the bound a shuffle join
    if not shape.n:
        return docs.select(id_col, F.lit(False).alias("contaminated"), F.array().cast("array<bigint>").alias("item_ids"),
                           F.lit(0).cast("long").alias("n_windows"), F.lit(False).alias("reparameterised"))

    # texts with enough windows of an item, whatever fills the slots
    found = text_windows(tokenised(texts.where("id is not null"), "_text"), sorted(shape.lengths), set(shape.typed))
    keys = bench.groupBy("item", "hash", "need", "need_any").agg(  # an item may repeat itself
        F.count_distinct(F.when(F.col("typed"), F.col("ipos"))).alias("typed"), F.count_distinct("ipos").alias("windows"))
    met = found.join(few(keys), "hash").distinct()  # a text may repeat itself too
    likely = (met.groupBy("id", "item", "need", "need_any").agg(F.sum("typed").alias("n_typed"), F.sum("windows").alias("n"))
              .where("n_typed >= need or n >= need_any").select("id", "item"))
    likely = stored(likely, "likely")
    again = of_ids(texts, likely.select("id").distinct(), "id")

    # these again, with their words: which windows fill their slots consistently
    again = tokenised(again, "_text")

    def placed(hashes: str, n: int) -> Column:
        return F.transform(window_hashes(hashes, n), lambda h, i: F.struct(
            h.alias("hash"), (i + 1).alias("pos"), F.slice("_w", i + 1, n).alias("w")))

    parts = [placed(h, n) for n in sorted(shape.lengths) for h in (("_h", "_p") if n in shape.typed else ("_p",))]
    spots = again.select("id", F.explode(F.concat(*parts)).alias("s")).select("id", "s.*")
    hits = spots.join(few(bench), "hash").join(likely, ["id", "item"], "left_semi")
    hits = hits.select("id", "item", "need", "need_any", "typed", "ipos", (F.col("pos") - F.col("ipos")).alias("shift"), F.filter(
        F.zip_with("slots", "w", lambda a, b: F.when(a.isNotNull(), F.struct(a.alias("mine"), b.alias("theirs")))),
        lambda x: x.isNotNull()).alias("pairs"))
    hits = stored(hits.distinct(), "hits")
    clash = (hits.select("id", "item", "shift", F.explode("pairs").alias("p")).groupBy("id", "item", "shift", F.col("p.mine").alias("mine"))
             .agg(F.min("p.theirs").alias("lo"), F.max("p.theirs").alias("hi")).where("lo <> hi")
             .groupBy("id", "item", "shift").agg(F.collect_set("mine").alias("bad")))
    fair = hits.join(clash, ["id", "item", "shift"], "left").where(
        F.col("bad").isNull() | ~F.exists("pairs", lambda p: F.array_contains("bad", p["mine"])))
    other = F.exists("pairs", lambda p: p["mine"] != p["theirs"])
    judged = fair.groupBy("id", "item", "need", "need_any").agg(
        F.count_distinct(F.when(F.col("typed"), F.col("ipos"))).alias("n_typed"), F.count_distinct("ipos").alias("n"),
        F.max(other).alias("other")).where("n_typed >= need or n >= need_any")
    per_text = judged.groupBy("id").agg(F.sort_array(F.collect_set("item")).alias("_items"), F.sum("n").alias("_n"), F.max("other").alias("_other"))
    out = docs.select(F.col(id_col).alias("_in")).join(per_text, F.col("_in") == F.col("id"), "left")
    return out.select(F.col("_in").alias(id_col), F.col("_items").isNotNull().alias("contaminated"),
                      F.coalesce(F.col("_items").cast("array<bigint>"), F.array().cast("array<bigint>")).alias("item_ids"),
                      F.coalesce("_n", F.lit(0)).cast("long").alias("n_windows"), F.coalesce("_other", F.lit(False)).alias("reparameterised"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark item; rows with a null id stay."""
    bad = contaminated(docs, items, id_col, text_col).where("contaminated").select(F.col(id_col).alias("_bad")).distinct()
    return docs.join(bad, docs[id_col] == bad["_bad"], "left_anti")


@query("op7_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
