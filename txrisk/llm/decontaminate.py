"""Benchmark decontamination by templates.

Texts become sequences of canonical tokens: numbers, names and units give way to
typed placeholders, everything else is in lower case. Windows of a template meet
windows of documents by hash. What stood in the placeholders is then compared:
where a question's slots were equal the document's must be, and where they
differed they must differ. So a question asked again with other numbers is found,
and other talk in the same words is not. An item shorter than a window is one window
of its own size. A capital at the start of a sentence is searched for both as a word
and as a name.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.tables import written

WINDOW = 8  # tokens
MIN_LITERAL = 5  # words of the windows found that are the item's own, at least
MIN_SHORT = 3  # the same (all, of items with fewer) for items shorter than a window
MIN_HITS = 3  # windows in line (all, of items with fewer)
RUN = 4  # tokens looked up first
MAX_HOLDERS = 8  # templates that share a window; of more it is boilerplate
MAX_BROADCAST = 2_000_000  # windows of the benchmark; beyond, windows are shuffled

FINDS_DDL = "doc_id long, item_id long, shift int, n_hits int, n_slot_hits int, consistent boolean"
NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"
# --- Fixed values: units of measure, as written after a number ---
UNITS = (
    "mm cm m km in ft mi yd g kg mg lb lbs oz ton tons l ml gal s sec second seconds min minute "
    "minutes h hr hour hours day days week weeks month months year years kmh mph km/h m/s ms hz "
    "khz mhz ghz w kw mw j kj cal kcal v a n pa bar k c f b kb mb gb tb dollar dollars euro euros "
    "cent cents percent degree degrees meter meters metre metres mile miles inch inches foot feet "
    "gram grams kilogram kilograms liter liters litre litres"
)
# ------------------------------------------------------------------
_PUNCTUATION = "!\"#$%&'()*,-.:;<>?[]{|}«»" + "".join(map(chr, range(0x2013, 0x2027)))
_MARK = r"[!-*,-.:;<>?\[\]{|}«»\x{2013}-\x{2026}]"  # the same
_GAP = r"\x20\x09-\x0D"
_ENDS = ".!?:"  # of a sentence
_NUMERIC = r"^[+-]?[0-9][0-9.,:/]*$"


def cores(text: str = "text") -> Column:
    """Words without punctuation around them, but for the mark that ended a sentence.
    A run of marks is looked at once, where it begins, however long."""
    ahead = rf"{_MARK}(?<![^{_GAP}]{_MARK}){_MARK}*+"
    behind = rf"{_MARK}(?<!{_MARK}{_MARK}){_MARK}*+(?<=([{_ENDS}])|[^{_ENDS}])(?=[{_GAP}]|\z)"
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), ahead, ""), behind, "$1")
    bare = F.btrim(bare, F.lit(" \t\n\x0b\x0c\r"))
    none = F.array().cast("array<string>")
    return F.when(F.length(bare) > 0, F.split(bare, f"[{_GAP}]+")).otherwise(none)


def lowered(words: str = "cores") -> Column:
    """The cores in lower case, without the marks of sentences."""
    return F.transform(words, lambda c: F.lower(F.rtrim(c, F.lit(_ENDS))))


def _numeric(core: Column) -> Column:
    return (core < ":") & core.rlike(_NUMERIC)  # few words sort before the colon


def _capital(core: Column) -> Column:
    return ((core < "[") | (core > "~")) & core.rlike(r"^\p{Lu}\p{Ll}")


def token_forms(code=lambda token: token) -> tuple[Column, Column]:
    """From the columns ``cores`` and ``low`` (as expressions they would be worked out
    again for every token): what ``code`` makes of each canonical token, and the same
    with every capital taken for a name. A capital at the start of a text or sentence is
    a word in the first."""
    units = UNITS.split()

    def token(x: Column, i: Column) -> Column:
        last, low = F.get("cores", i - 1), F.get("low", i)
        inside = ~F.coalesce(F.substring(last, -1, 1).isin(*_ENDS), F.lit(True))
        unit = low.isin(units)
        return (
            F.when((x >= "a") & (x < "{") & ~unit, code(low))  # most words are that
            .when(_numeric(low), code(F.lit(NUMBER)))
            .when(_capital(x) & inside, code(F.lit(NAME)))
            .when(unit & F.coalesce(_numeric(F.get("low", i - 1)), F.lit(False)), code(F.lit(UNIT)))
            .otherwise(code(low))
        )

    named = F.zip_with("tokens", "cores", lambda t, x: F.when(_capital(x), code(F.lit(NAME))).otherwise(t))
    return F.transform("cores", token), named


def _is_slot(token: Column) -> Column:
    return token.isin(NUMBER, NAME, UNIT)


def _slot_code(code: Column) -> Column:
    return code.isin(*[F.xxhash64(F.lit(s)) for s in (NUMBER, NAME, UNIT)])


def _with_code(codes: Column | str, behind: int):
    return lambda x, i: F.xxhash64(x, F.get(codes, i + behind))


def _hashes(runs: Column, run: int, size: int) -> Column:
    """Of runs of ``run`` codes those of ``size``: two runs that cover it, and the size,
    since of codes that come again and again other sizes are covered by the same two."""
    if run == size:
        return runs
    return F.transform(runs, lambda x, i: F.xxhash64(F.lit(size), x, F.get(runs, i + size - run)))


def _keyed(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """``hash`` in place of ``codes, part, span``: what :func:`with_windows` gives such a
    window. One of slots only says nothing by their kinds: there the words count."""
    rest = [c for c in windows.columns if c not in ("codes", "part", "span")]
    whole = F.lit(None).cast("long")
    run = 1
    for size in sorted(sizes):
        while 2 * run <= size:
            last = "codes" if run == 1 else f"codes_{run}"
            windows = windows.withColumn(f"codes_{2 * run}", F.transform(last, _with_code(last, run)))
            run *= 2
        runs = F.col("codes" if run == 1 else f"codes_{run}")
        first = F.get(runs, F.lit(0))
        both = first if run == size else F.xxhash64(F.lit(size), first, F.get(runs, F.lit(size - run)))
        whole = F.when(F.col("span") == size, both).otherwise(whole)
    only_slots = ~F.exists("codes", lambda c: ~_slot_code(c))
    key = F.when(only_slots, F.xxhash64("part")).otherwise(whole)
    return windows.select(key.alias("hash"), *rest)


def with_windows(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """``doc_id, pos, hash, plain`` of every window, from 0, of rows ``doc_id, low, tokens,
    named``: with first words as words, and, where that differs, as names."""
    parts = []
    for size in sizes:
        for form in ("tokens", "named"):
            # Every step is a column of its own: as one expression it would be worked out
            # again wherever it is used.
            run, name = 1, form
            while 2 * run <= size:
                texts = texts.withColumn(f"{form}_{2 * run}", F.transform(name, _with_code(name, run)))
                run, name = 2 * run, f"{form}_{2 * run}"
            texts = texts.withColumn(f"{form}_of_{size}", _hashes(F.col(name), run, size))
        parts.append(_windows(size))
    # Of an inner generator Spark would first ask, by another run, what it gives.
    return texts.select("doc_id", F.inline_outer(F.concat(*parts)))


def _windows(size: int) -> Column:
    plain, named = f"tokens_of_{size}", f"named_of_{size}"
    starts = F.sequence(F.lit(0), F.size("tokens") - size)

    def entry(i: Column, hash_: Column, form: Column) -> Column:
        return F.struct(i.alias("pos"), hash_.alias("hash"), form.alias("plain"))

    def of_slots(codes: str, i: Column) -> Column:
        whole = _slot_code(F.get(codes, i))
        for k in range(1, size):
            whole = whole & _slot_code(F.get(codes, i + k))
        return whole

    def part(i: Column) -> Column:
        return F.xxhash64(F.slice("low", i + 1, F.lit(size)))

    parts = [
        F.transform(starts, lambda i: entry(i, F.get(plain, i), F.lit(True))),
        F.transform(
            F.filter(starts, lambda i: F.get(plain, i) != F.get(named, i)),
            lambda i: entry(i, F.get(named, i), F.lit(False)),
        ),
        F.transform(
            F.filter(starts, lambda i: of_slots("named", i)), lambda i: entry(i, part(i), of_slots("tokens", i))
        ),
    ]
    none = F.array().cast("array<struct<pos:int,hash:bigint,plain:boolean>>")
    return F.when(F.size("tokens") >= size, F.concat(*parts)).otherwise(none)


def _pattern(values: Column) -> Column:
    """For each value the place of the first equal one."""
    return F.transform(values, lambda v: F.array_position(values, v))


def _literals(form: Column) -> Column:
    return F.size(F.filter(form, lambda t: ~_is_slot(t)))


def templates(benchmark: DataFrame) -> DataFrame:
    """``item_id, tokens, words, slots, firsts, span``: one row, of the lowest id, for items
    alike in template and in which slots are equal; also in words, if the item is
    short or has a window of few literal words, whose slots' values count.

    ``firsts`` are the places of words that may be names or not.
    """
    cut = benchmark.filter("item_id IS NOT NULL").select("item_id", cores().alias("cores"))
    cut = cut.filter(F.size("cores") > 0).withColumn("low", lowered())
    token, named = token_forms()
    rows = cut.withColumn("tokens", token).select(
        "item_id", "tokens", named.alias("named"), F.col("low").alias("words"),
        F.least(F.size("cores"), F.lit(WINDOW)).alias("span"),
    )
    places = F.sequence(F.lit(0), F.size("tokens") - 1)
    rows = rows.withColumn("slots", F.filter(places, lambda i: _is_slot(F.get("tokens", i))))
    rows = rows.withColumn("firsts", F.filter(places, lambda i: F.get("tokens", i) != F.get("named", i)))
    starts = F.sequence(F.lit(0), F.size("tokens") - F.col("span"))
    few = F.exists(starts, lambda i: _literals(F.slice("tokens", i + 1, F.col("span"))) < MIN_LITERAL)
    values = F.transform("slots", lambda i: F.get("words", i))
    own = F.when(few | (F.size("tokens") < WINDOW), F.col("words"))
    columns = ["words", "slots", "firsts", "span"]
    found = rows.groupBy("tokens", _pattern(values).alias("pattern"), own.alias("own")).agg(
        F.min("item_id").alias("item_id"), F.min_by(F.struct(*columns), "item_id").alias("of")
    )
    return found.select("item_id", "tokens", "of.*")


def _template_windows(rows: DataFrame) -> DataFrame:
    """``hash, item_id, at, with_slots, as_typed, needed`` of the windows searched for, in
    every form: each of a window's first words as a name and not.

    What more than ``MAX_HOLDERS`` templates hold is boilerplate, and no window of theirs;
    an item that has nothing else needs all its windows in line.
    """

    def bit(j: Column) -> Column:
        return F.pow(F.lit(2.0), j).cast("int")

    starts = F.sequence(F.lit(0), F.size("tokens") - F.col("span"))
    windows = rows.withColumn("at", F.explode(starts)).withColumn(
        "may",
        F.aggregate(
            F.filter("firsts", lambda p: p.between(F.col("at"), F.col("at") + F.col("span") - 1)),
            F.lit(0),
            lambda sum_, p: sum_ + bit(p - F.col("at")),
        ),
    )
    masks = F.filter(F.sequence(F.lit(0), F.col("may")), lambda m: m.bitwiseAND(F.col("may")) == m)
    windows = windows.withColumn("mask", F.explode(masks))
    form = F.transform(
        F.slice("tokens", F.col("at") + 1, F.col("span")),
        lambda t, j: F.when(F.col("mask").bitwiseAND(bit(j)) != 0, NAME).otherwise(t),
    )
    windows = windows.withColumn("form", form).withColumns(
        {"literals": _literals(F.col("form")), "codes": F.transform("form", lambda t: F.xxhash64(t))}
    )
    words = F.slice("words", F.col("at") + 1, F.col("span"))
    kept = windows.select(
        "codes",
        words.alias("part"),
        "span",
        "item_id",
        F.xxhash64("tokens").alias("template"),
        "at",
        (F.col("literals") < F.col("span")).alias("with_slots"),
        (F.col("mask") == 0).alias("as_typed"),
        (F.col("literals") >= MIN_LITERAL).alias("rich"),
    )
    sizes = [r["span"] for r in rows.select("span").distinct().collect()]
    kept = written(_keyed(kept, sizes), "decontaminate-windows")
    held = kept.groupBy("hash").agg((F.count_distinct("template") <= MAX_HOLDERS).alias("own"))
    kept = kept.join(held, "hash")
    typed = F.col("as_typed")
    counts = kept.groupBy("item_id").agg(
        F.count_if(typed).alias("all"),
        F.count_if(typed & F.col("own")).alias("n_own"),
        F.count_if(typed & F.col("own") & F.col("rich")).alias("n_rich"),
    )
    some = F.least(F.when(F.col("n_rich") > 0, F.col("n_rich")).otherwise(F.col("n_own")), F.lit(MIN_HITS))
    needed = F.when(F.col("n_own") > 0, some).otherwise(F.col("all"))
    told = kept.join(counts, "item_id").filter("own OR n_own = 0")
    return told.select("hash", "item_id", "at", "with_slots", "as_typed", needed.alias("needed"))


def _short_runs(column: str, at: Column, size: int) -> Column:
    """Hash of the ``size`` codes from a place on."""
    return F.xxhash64(*[F.get(column, at + k) for k in range(size)])


def _tokens(texts: DataFrame) -> DataFrame:
    """``doc_id, low, tokens, named``: words in lower case, and the hashes of tokens."""
    words = texts.select("doc_id", cores().alias("cores"))
    words = words.select("doc_id", "cores", lowered().alias("low"))
    token, named = token_forms(F.xxhash64)
    tokens = words.select("*", token.alias("tokens"))
    return tokens.select("doc_id", "low", "tokens", named.alias("named"))


def _may_hold(tokens: DataFrame, rows: DataFrame, span: int) -> DataFrame:
    """``doc_id`` of texts that may hold a window of ``span`` tokens or more.

    Any such window has inside it a run of ``size`` tokens that begins at a place
    divisible by ``step``; so only these are looked up, among all runs of the templates
    (first words as names and not).
    """
    size = min(RUN, span)
    step = span - size + 1
    starts = F.sequence(F.lit(0), F.size("tokens") - size)
    forms = rows.withColumn("at", F.explode(starts))
    part = F.slice("tokens", F.col("at") + 1, F.lit(size))
    firsts = F.filter("firsts", lambda p: p.between(F.col("at"), F.col("at") + size - 1))
    for k in range(size):  # each first word in both readings
        code = F.get(part, F.lit(k))
        may = F.array_contains(firsts, F.col("at") + k)
        forms = forms.withColumn(f"code_{k}", F.when(may, F.array(code, F.lit(NAME))).otherwise(F.array(code)))
    for k in range(size):
        forms = forms.withColumn(f"code_{k}", F.explode(f"code_{k}"))
    known = forms.select(F.xxhash64(*[F.xxhash64(f"code_{k}") for k in range(size)]).alias("hash")).distinct()
    known = written(known, "decontaminate-runs")
    sent = F.broadcast(known) if known.count() <= MAX_BROADCAST else known
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size("tokens") - size, F.lit(0)), F.lit(step)),
                      lambda i: i + size <= F.size("tokens"))
    looked_up = F.flatten(
        F.transform(
            places,
            lambda i: F.array_distinct(F.array(_short_runs("tokens", i, size), _short_runs("named", i, size))),
        )
    )
    # Of an inner generator Spark would first ask, by another run, what it gives.
    runs = tokens.select("doc_id", F.explode_outer(looked_up).alias("hash"))
    return runs.join(sent, "hash", "left_semi").select("doc_id").distinct()


def find(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, shift, n_hits, n_slot_hits, consistent`` of every document
    and template with enough windows in line; ``shift`` is how far the document's
    place is behind the template's.

    Windows with slots count only if the slots inside the windows hit agree in which
    are equal, and enough of the words there are the same; what the document has at
    the item's other places is no matter.
    """
    rows = written(templates(benchmark), "decontaminate-templates")
    # The few windows of a benchmark, counted first, go to where the texts are, each with
    # all that hold it.
    windows = written(_template_windows(rows), "decontaminate-own")
    held = windows.groupBy("hash").agg(
        F.collect_list(F.struct("item_id", "at", "with_slots", "as_typed", "needed")).alias("holders")
    )
    sent = F.broadcast(held) if windows.count() <= MAX_BROADCAST else held
    sizes = sorted(r["span"] for r in rows.select("span").distinct().collect())
    texts = documents.filter("doc_id IS NOT NULL").select("doc_id", "text")
    if not sizes:
        return documents.sparkSession.createDataFrame([], FINDS_DDL)
    ids = written(_may_hold(_tokens(texts), rows, sizes[0]), "decontaminate-may")
    few = F.broadcast(ids) if ids.count() <= MAX_BROADCAST else ids
    seen = with_windows(_tokens(texts.join(few, "doc_id", "left_semi")), sizes)
    met = seen.join(sent, "hash").select("doc_id", "pos", "plain", F.inline("holders"))
    place = ["doc_id", "item_id", (F.col("pos") - F.col("at")).alias("shift")]
    hits = met.groupBy(*place).agg(
        F.collect_set(F.when(~F.col("with_slots"), F.col("at"))).alias("literal_at"),
        F.collect_set(F.when(F.col("plain") & F.col("as_typed"), F.col("at"))).alias("typed_at"),
        F.collect_set("at").alias("hit_at"),
        F.first("needed").alias("needed"),
    )
    enough = hits.filter(F.size("hit_at") >= F.col("needed"))
    enough = written(enough, "decontaminate-hits")
    literal = F.size("literal_at") >= F.col("needed")
    sure = enough.filter(literal).withColumns(
        {"n_found": F.size("typed_at"), "consistent": F.lit(None).cast("boolean")}
    )
    unsure = _checked(enough.filter(~literal), texts, rows).filter("consistent")
    out = [
        "doc_id",
        "item_id",
        "shift",
        F.size("literal_at").alias("n_hits"),
        (F.col("n_found") - F.size("literal_at")).alias("n_slot_hits"),
        "consistent",
    ]
    return sure.select(*out).unionByName(unsure.select(*out))


def _checked(found: DataFrame, texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Adds whether the slots of the document agree with those of the template in
    the windows hit, and how many windows these are. First words count as names
    in one trial, and as what they are in the other."""
    items = rows.select("item_id", "slots", "firsts", "span", F.col("words").alias("ours"))
    told = found.join(items, "item_id").join(texts, "doc_id")
    told = told.withColumn("cores", cores()).withColumn("theirs", lowered())
    n = F.size("ours")
    least = F.when(n < WINDOW, F.least(n, F.lit(MIN_SHORT))).otherwise(F.lit(MIN_LITERAL))

    def agree(hit: str, slots: Column) -> Column:
        def inside(p: Column) -> Column:
            return F.exists(hit, lambda w: p.between(w, w + F.col("span") - 1))

        def word(p: Column) -> Column:
            return F.get("theirs", p + F.col("shift"))

        same = F.filter(
            F.sequence(F.lit(0), n - 1), lambda p: (word(p) == F.get("ours", p)) & inside(p)
        )
        at = F.filter(slots, inside)
        patterns = [_pattern(F.transform(at, f)) for f in (word, lambda p: F.get("ours", p))]
        return (F.size(hit) >= F.col("needed")) & (F.size(same) >= least) & (patterns[0] == patterns[1])

    by_name = agree("hit_at", F.concat("slots", "firsts"))
    as_typed = agree("typed_at", F.col("slots"))
    return told.withColumn(
        "n_found", F.when(by_name, F.size("hit_at")).when(as_typed, F.size("typed_at"))
    ).withColumn("consistent", F.col("n_found").isNotNull())


def judge(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_items, item_id, n_hits, contaminated``, a row per row.

    ``item_id`` is the template with most windows found (lowest id of equals) and
    ``n_hits`` their number. Rows of one id are judged together; a row without id,
    with null or empty text is clean. Items without id or without any word are not
    searched for. Other columns are left behind.
    """
    found = find(documents, benchmark).withColumn("n", F.col("n_hits") + F.col("n_slot_hits"))
    best = F.struct(F.col("n"), (-F.col("item_id")).alias("id"))
    by = found.groupBy("doc_id").agg(
        F.count_distinct("item_id").alias("n_items"), F.max(best).alias("best")
    )
    return documents.select("doc_id").join(by, "doc_id", "left").select(
        "doc_id",
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        (-F.col("best.id")).alias("item_id"),
        F.coalesce("best.n", F.lit(0)).cast("long").alias("n_hits"),
        F.col("best").isNotNull().alias("contaminated"),
    )


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = find(documents, benchmark).select("doc_id").distinct()
    return documents.join(found, "doc_id", "left_anti")
