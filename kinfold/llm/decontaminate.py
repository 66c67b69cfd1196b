"""Benchmark passages in documents, also with other numbers, names and units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tokens of a window, and of these at least so many that are no placeholder if other values are to match.
WINDOW, LITERAL = 8, 5
#: Tokens in a row that make a leak; a shorter item must occur in full.
LEAK_TOKENS = 13
#: More windows than this are joined by a shuffle.
MOST_BROADCAST = 1_000_000
#: Words of a phrase that a document must hold for a window of the benchmark to occur in it; with more such phrases than the second number, no document is left out beforehand.
PHRASE, MOST_PHRASES = 4, 50_000

# Words that count as numbers, and units.
NUMBERS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen
nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split()
UNITS = """mm cm m km meter meters metre metres kilometer kilometers kilometre kilometres inch inches foot feet yard yards mile miles mg g kg gram grams
kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day
days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees mph kmh""".split()

SPACES = "[ \\t\\n\\x0B\\f\\r]+"
#: In front of a capital at the start of a text or sentence comes a mark, since such a capital makes no name.
STARTS = "(^|[.!?])([ \\t\\n\\x0B\\f\\r\"'(]*)(\\p{Lu})"
#: The same after a colon, a blank line or a bullet; a single line break may also be the wrapping of a line.
MORE_STARTS = "([:\u2022\u2023]|\\n[ \\t\\r]*\\n|(?:^|\\n)[ \\t]*(?:[-*\u2013\u2014>#]+|[0-9]{1,3}[.)]))([ \\t\\n\\x0B\\f\\r\"'(]*)(\\p{Lu})"
NOISE = "[^\\p{L}\\p{N}\\x01 \\t\\n\\x0B\\f\\r]+"


def _joined_digits(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    # Few texts hold the mark's character.
    plain = F.when(whole.contains("\x01"), F.translate(whole, "\x01", "")).otherwise(whole)
    return F.regexp_replace(plain, "([0-9])[.,:/]([0-9])", "$1$2")


def tokens(text: Column) -> Column:
    """Words of letters and digits as written; \\x01 leads those that begin a sentence. Punctuation separates.

    A sign between digits falls away (1,000 is 1000), so that a number stays one token.
    """
    clean = _joined_digits(text)
    clean = F.regexp_replace(F.regexp_replace(clean, STARTS, "$1$2\x01$3"), MORE_STARTS, "$1$2\x01$3")
    clean = F.regexp_replace(F.regexp_replace(clean, NOISE, " "), SPACES, " ")
    return F.split(F.trim(clean), " ")


def template(token: Column) -> Column:
    """``<n>`` for numbers, ``<u>`` for units, ``<p>`` for capitalised words within a sentence, else the lower-cased word."""
    first = F.substring(token, 1, 1)
    plain = F.when(first == "\x01", F.substring(token, 2, 1 << 30)).otherwise(token)
    low = F.lower(plain)
    name = (first != "\x01") & (first != F.lower(first)) & (F.substring(token, 2, 1) != F.upper(F.substring(token, 2, 1)))
    return F.when(first.between("0", "9") | low.isin(NUMBERS), "<n>").when(low.isin(UNITS), "<u>").when(name, "<p>").otherwise(low)


def _holds_one_of(text: Column, phrases: dict[int, list[int]]) -> Column:
    """Whether the text holds one of the phrases, given by length as hashes of the hashes of their lower-cased words.

    Marks of sentences stand in front of words only, so words are those of :func:`tokens` without them.
    """
    hashes = F.transform(F.split(_joined_digits(text), "[^\\p{L}\\p{N}]+"), lambda w: F.xxhash64(F.lower(w)))

    def at(h: Column, i: Column) -> Column:
        found = F.lit(False)
        for length, known in sorted(phrases.items()):
            # Behind the last word there is null, which counts nothing in a hash: a shorter phrase may pass as well.
            found = found | F.xxhash64(*[F.get(h, i + k) for k in range(length)]).isin(known)
        return found

    # The array around the hashes lets them be worked out once.
    return F.exists(F.array(hashes), lambda h: F.exists(F.sequence(F.lit(0), F.size(h) - 1), lambda i: at(h, i)))


def _phrase(sure: Column) -> Column:
    """Of the runs of words in ``sure`` (null where any may stand), PHRASE words or all of the longest; the longest words, as they are the rarest."""
    whole = lambda n: F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(sure) - n + 1)), lambda i: F.slice(sure, i, n)), lambda x: (F.size(x) == n) & F.forall(x, lambda w: w.isNotNull()))
    best = [F.array_max(F.transform(whole(n), lambda x: F.struct(F.length(F.array_join(x, "")).alias("size"), x.alias("words")))) for n in range(PHRASE, 0, -1)]
    return F.coalesce(*best)["words"]


def windows(texts: DataFrame, keys: list[str], text_column: str, widths: list[int] | None = None, lead: bool = False) -> DataFrame:
    """``keys, at, word_at, last, hash, slots, wide, verbatim, leads`` of the windows of each text, of template and of plain words.

    In the template, numbers or names in a row, also joined by *and*, are one token, whose value is all their words.
    ``at`` counts template tokens and is null where a window is of plain lower-cased words only; ``word_at`` and
    ``last`` count words. Template windows of fewer than LITERAL literal tokens have their values in the hash. Windows
    of words are made where a placeholder stands; without one both are the same window. Those are ``verbatim``.

    Windows have each of the ``widths``; without any, WINDOW tokens, or all of a shorter text. With ``lead``, the
    window at the start comes also as it is when its first word stands within a sentence, where a capital makes a name; ``leads`` marks it,
    and ``sure`` has the words that any text with an equal window holds at these places in a row; null where others may stand.
    """
    made = texts.select(*keys, tokens(F.col(text_column)).alias("_words")).filter(F.element_at("_words", 1) != "")
    made = made.select(*keys, F.substring(F.regexp_replace(F.element_at("_words", 1), "\x01", ""), 1, 1).alias("_first"), F.transform("_words", template).alias("_forms"), F.transform("_words", lambda w: F.lower(F.translate(w, "\x01", ""))).alias("_low"))
    made = made.select("*", F.transform("_forms", lambda f: F.substring(f, 1, 1) == "<").alias("_typed"), F.size("_low").alias("_n"))
    made = made.select("*", F.array_contains("_typed", True).alias("_some"))
    form = lambda i: F.get("_forms", i - 1)
    of_run = lambda i: form(i).isin("<n>", "<p>")
    goes_on = lambda i: (of_run(i) & ((form(i - 1) == form(i)) | ((form(i - 1) == "and") & (form(i - 2) == form(i))))) | ((form(i) == "and") & of_run(i - 1) & (form(i - 1) == form(i + 1)))
    places = F.sequence(F.lit(1), F.col("_n") + 1)
    starts = F.when(F.col("_some"), F.filter(places, lambda i: ~F.coalesce(goes_on(i), F.lit(False)))).otherwise(places)
    made = made.select("*", F.transform("_forms", lambda f: F.xxhash64(f)).alias("_hashes"), starts.alias("_starts"))
    at_start = lambda values: F.when(F.size("_starts") == F.col("_n") + 1, F.col(values)).otherwise(F.transform(F.slice("_starts", 1, F.size("_starts") - 1), lambda i: F.get(values, i - 1)))
    made = made.select("*", at_start("_hashes").alias("_tokens"), at_start("_typed").alias("_types"), (F.size("_starts") - 1).alias("_m"))
    start = lambda k: F.get("_starts", k - 1)
    value = lambda k: F.array_join(F.slice("_low", start(k), start(k + 1) - start(k)), " ")

    def window(at: Column, first: Column, last: Column, hash_: Column, slots: Column, wide: Column, verbatim: Column, sure: Column, leads: bool = False) -> Column:
        more = [sure.alias("sure")] if lead else []
        return F.struct(at.alias("at"), first.alias("word_at"), last.alias("last"), hash_.alias("hash"), slots.alias("slots"), wide.alias("wide"), verbatim.alias("verbatim"), F.lit(leads).alias("leads"), *more)

    none = F.lit(None).cast("array<string>")

    def in_template(k: Column, wide: Column, hashes: Column, slots: Column, leads: bool = False) -> Column:
        own = F.when(slots.isNull() | (wide - F.size(slots) >= LITERAL), F.xxhash64(hashes)).otherwise(F.xxhash64(hashes, slots))
        literal = F.transform(F.sequence(k, k + wide - 1), lambda j: F.when(~F.get("_types", j - 1) & (F.lit(not leads) | (j > k)), F.get("_low", start(j) - 1)))
        # Where the values are in the hash, all words agree.
        sure = F.when(slots.isNotNull() & (wide - F.size(slots) >= LITERAL), literal).otherwise(F.slice("_low", start(k), start(k + wide) - start(k)))
        return window(k, start(k), start(k + wide) - 1, own, slots, wide, slots.isNull(), sure, leads)

    def of_width(wide: Column, words_wide: Column) -> Column:
        def templates(k: Column) -> Column:
            types = F.slice("_types", k, wide)
            # The values are looked up only where there is a placeholder.
            slots = F.when(F.array_contains(types, True), F.transform(F.filter(F.sequence(k, k + wide - 1), lambda j: F.get("_types", j - 1)), value))
            return in_template(k, wide, F.slice("_tokens", k, wide), slots)

        def words(i: Column) -> Column:
            return window(F.lit(None).cast("int"), i, i + words_wide - 1, F.xxhash64(F.transform(F.slice("_low", i, words_wide), lambda w: F.xxhash64(w))), none, words_wide, F.lit(True), F.slice("_low", i, words_wide))

        every = F.when(F.col("_m") >= wide, F.transform(F.sequence(F.lit(1), F.col("_m") - wide + 1), templates))
        held = F.filter(F.sequence(F.lit(1), F.col("_n") - words_wide + 1), lambda i: F.array_contains(F.slice("_typed", i, words_wide), True))
        plain = F.when(F.col("_some") & (F.col("_n") >= words_wide), F.transform(held, words))
        return F.concat(F.coalesce(every, F.slice(F.array(templates(F.lit(1))), 1, 0)), F.coalesce(plain, F.slice(F.array(words(F.lit(1))), 1, 0)))

    each = [of_width(F.lit(w), F.lit(w)) for w in widths] if widths else [of_width(F.least(F.lit(WINDOW), F.col("_m")), F.least(F.lit(WINDOW), F.col("_n")))]
    if lead:
        wide = F.least(F.lit(WINDOW), F.col("_m"))
        rest = F.transform(F.filter(F.sequence(F.lit(1), wide), lambda j: (j == 1) | F.get("_types", j - 1)), value)
        within = in_template(F.lit(1), wide, F.concat(F.array(F.xxhash64(F.lit("<p>"))), F.slice("_tokens", 2, wide - 1)), rest, True)
        may_be_name = ~F.get("_types", F.lit(0)) & (F.col("_first") != F.lower("_first")) & ~F.coalesce(form(F.lit(2)) == "<p>", F.lit(False))
        each.append(F.when(may_be_name, F.array(within)).otherwise(F.slice(F.array(within), 1, 0)))
    made = made.select(*keys, F.explode(each[0] if len(each) == 1 else F.concat(*each)).alias("_w"))
    return made.select(*keys, "_w.*")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, kind, n_windows, n_item_windows, from_token, to_token, text_hash``: benchmark items found in documents.

    Windows of an item and of a document meet by hash, and those that keep their distance form a passage. There are
    two kinds. Lower-cased words find what is verbatim, of any make-up and in any case; an item shorter than a window
    is one window. In templates, numbers, names and units are typed placeholders, so that a passage is also found with
    other values. A window whose values agree counts by itself. Windows with other values count, per run of
    neighbours, if each value of the item stands for one value of the document there. A passage is a leak when its
    windows that count cover LEAK_TOKENS tokens, or are all but one of a shorter item.

    ``kind`` is ``exact`` if all values agree in the windows given and ``changed`` if not. Where words and
    template show the same passage, the template's is given. ``n_item_windows`` counts the item's windows
    of the same kind; tokens are words, counted from 1 in the document. ``text_hash`` tells rows of the same id apart.

    Only the windows of the benchmark are broadcast, after a count; a larger benchmark is joined by a shuffle.
    Windows of documents are made and matched in the task that reads them. A document that holds none of the phrases,
    one per window of the benchmark, that no equal window lacks, has nothing to match and no windows made.

    Null and empty texts have no windows; null ids are ids like others. Repeated rows count once, an item that occurs
    several times in a document is reported for each passage. An empty table on either side gives no rows.
    """
    source = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("_row"), F.col(text_column).alias("_text"))
    items = benchmark.select(F.col(item_column).alias("item_id"), F.xxhash64(F.coalesce(F.col(item_text), F.lit(""))).alias("_item"), F.col(item_text).alias("_text")).distinct()
    known = windows(items, ["item_id", "_item"], "_text", lead=True)
    phrase = known.select(_phrase(F.col("sure")).alias("words"))
    phrases = phrase.select(F.size("words").alias("length"), F.xxhash64(F.transform("words", lambda w: F.xxhash64(w))).alias("hash")).distinct().limit(MOST_PHRASES + 1).collect()
    if 0 < len(phrases) <= MOST_PHRASES:
        by_length: dict[int, list[int]] = {}
        for length, hash_ in phrases:
            by_length.setdefault(length, []).append(hash_)
        source = source.filter(_holds_one_of(F.col("_text"), by_length))
    known = known.select("item_id", "_item", "hash", *[F.col(c).alias(f"_item_{c}") for c in ("at", "word_at", "slots", "wide", "verbatim", "leads")])
    totals = known.groupBy(F.col("item_id").alias("_total_id"), F.col("_item").alias("_total_item")).agg(
        F.size(F.collect_set(F.when(F.col("_item_verbatim"), F.col("_item_word_at")))).cast("bigint").alias("_of_words"),
        F.size(F.collect_set("_item_at")).cast("bigint").alias("_of_template"),
    )
    # Only items shorter than a window have other widths: WINDOW - 1 of them at most.
    found = known.groupBy("_item_wide").count().collect()
    small = sum(r["count"] for r in found) <= MOST_BROADCAST
    seen = windows(source, ["doc_id", "_row"], "_text", sorted(r["_item_wide"] for r in found) or [WINDOW])
    met = seen.join(F.broadcast(known) if small else known, "hash").filter(F.col("wide") == F.col("_item_wide"))
    pair = lambda a, b: F.struct(a.alias("item"), b.alias("doc"))
    fills = F.zip_with("_item_slots", "slots", pair)
    # The first word of an item, if it is the same, is a word that begins a sentence and stands for nobody.
    stays = F.col("_item_leads") & (F.get("slots", F.lit(0)) == F.get("_item_slots", F.lit(0)))
    fills = F.when(F.col("slots") != F.col("_item_slots"), F.when(stays, F.slice(fills, 2, F.size(fills))).otherwise(fills))
    shift = F.col("word_at") - F.col("_item_word_at")

    def shown(template_: bool, shift_: Column, at: Column, fills_: Column, leads: Column) -> Column:
        return F.struct(F.lit(template_).alias("template"), shift_.alias("shift"), F.struct(at.alias("at"), F.col("word_at").alias("first"), F.col("last").alias("last"), shift.alias("shift"), fills_.alias("fills"), leads.alias("leads")).alias("window"))

    in_words = F.when(F.col("verbatim") & F.col("_item_verbatim"), shown(False, shift, F.col("word_at"), F.when(F.lit(False), fills), F.lit(False)))
    in_template = F.when(F.col("at").isNotNull() & F.col("_item_at").isNotNull(), shown(True, F.col("at") - F.col("_item_at"), F.col("at"), fills, F.col("_item_leads")))
    by = ["doc_id", "_row", "item_id", "_item"]
    met = met.select(*by, F.explode(F.array_compact(F.array(in_words, in_template))).alias("_m")).select(*by, "_m.*")
    passages = met.groupBy(*by, "template", "shift").agg(F.sort_array(F.collect_set(F.col("window"))).alias("_all"))
    passages = passages.select("*", F.filter("_all", lambda w: w["fills"].isNotNull()).alias("_changed"), F.filter("_all", lambda w: w["fills"].isNull()).alias("_same"))
    # Changed windows that follow each other are judged together.
    first = F.filter(F.sequence(F.lit(1), F.size("_changed") + 1), lambda i: (i == 1) | (i > F.size("_changed")) | (F.get("_changed", i - 1)["at"] - F.get("_changed", i - 2)["at"] > 1))
    passages = passages.withColumn("_first", F.when(F.size("_changed") > 0, first).otherwise(F.expr("array(1)")))
    runs = F.transform(F.slice("_first", 1, F.size("_first") - 1), lambda i, k: F.slice("_changed", i, F.get("_first", k + 1) - i))

    def consistent(run: Column) -> Column:
        pairs = F.array_distinct(F.flatten(F.transform(run, lambda w: w["fills"])))
        return F.size(pairs) == F.size(F.array_distinct(F.transform(pairs, lambda x: x["item"])))

    passages = passages.withColumn("_filled", F.flatten(F.filter(runs, consistent)))
    passages = passages.withColumn("_counted", F.concat("_same", "_filled"))
    # A start read as a name helps to find a passage; it is given only if there is nothing else.
    own = F.filter("_counted", lambda w: ~w["leads"])
    passages = passages.withColumn("_given", F.when(F.size(own) > 0, own).otherwise(F.col("_counted")))
    same_item = (F.col("_item") == F.col("_total_item")) & F.col("item_id").eqNullSafe(F.col("_total_id"))
    passages = passages.join(F.broadcast(totals) if small else totals, same_item)
    number = lambda found: F.size(F.array_distinct(F.transform(found, lambda w: w["at"]))).cast("bigint")
    out = passages.select(
        *by,
        "template",
        F.when(F.exists("_given", lambda w: w["fills"].isNotNull()), "changed").otherwise("exact").alias("kind"),
        number("_given").alias("n_windows"),
        number("_counted").alias("_number"),
        F.when(F.col("template"), F.col("_of_template")).otherwise(F.col("_of_words")).alias("n_item_windows"),
        F.array_min(F.transform("_given", lambda w: w["first"])).alias("from_token"),
        F.array_max(F.transform("_given", lambda w: w["last"])).alias("to_token"),
        F.array_distinct(F.transform("_given", lambda w: w["shift"])).alias("_shifts"),
    )
    enough = F.least(F.lit(LEAK_TOKENS - WINDOW + 1), F.greatest(F.lit(1), F.col("n_item_windows") - 1))
    out = out.filter(F.col("_number") >= enough)
    best = F.max(F.struct("template", "n_windows", "kind", "n_item_windows", "from_token", "to_token")).alias("_best")
    out = out.withColumn("_shift", F.explode("_shifts")).groupBy(*by, "_shift").agg(best).select(*by, "_best.*").distinct()
    return out.select("doc_id", "item_id", "kind", "n_windows", "n_item_windows", "from_token", "to_token", F.col("_row").alias("text_hash"))
