"""Personal data: base patterns, and terms that give protected values away.

Everything here is DataFrame expressions; no Python runs on the executors.

*Base spans.*  Emails, IPv4 addresses, card numbers and telephone numbers are
found by pattern, leftmost and non-overlapping per kind, and kept if they
pass their check (address parts, Luhn sum, number of digits).  Offsets are
code points, end exclusive.

*Disclosing terms.*  The values found are protected entities.  Terms are the
words of a text (between white space or full-width punctuation, punctuation at
their ends dropped, lower case) of three characters at least, one of them a
letter; digits, ``_`` and ``-`` may stand inside, so user names and account
names count, and names of two Han characters.  A term co-occurs with every entity of its text, however far
away; over the whole corpus (equal texts counted once, so copies prove nothing)

    PMI(t; c) = log2(N * n(t, c) / (n(t) * n(c)))        IC(c) = log2(N / n(c))

says how much of entity ``c`` the term ``t`` gives away.  A term seen with an
entity in ``TOGETHER`` texts at least is generalised where
``PMI >= GENERALISE * IC`` and removed where ``PMI >= REMOVE * IC``, wherever
it stands, in texts without the entity too.

What is joined is cut by exact bounds only: an entity or a term of fewer than
``TOGETHER`` texts has no such pair, and ``PMI >= GENERALISE * IC`` asks for
``n(t) <= n(c) * (N / n(c)) ** (1 - GENERALISE)``.  Helper tables are broadcast
up to ``MAX_BYTES``, measured; beyond, joins by text are salted by input
partition, so copies of one text spread, and terms that are more than one in
``HOT_SHARE`` of all are joined apart from the rest.

Defined cases: null text is empty (in ``sanitise`` it stays null); a null id
is carried; rows that repeat are each reported; spans of different kinds may
overlap and are all reported, ``sanitise`` merges them; extra columns are
ignored, or kept by ``sanitise``, whatever their names; an empty table gives an
empty result; a very long text is one row, its spans are made in chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsieve.llm.tables import save, shared_folder

KINDS = ("email", "ip", "card", "phone")
TOGETHER = 3
GENERALISE, REMOVE = 0.9, 0.99
#: Helper tables are broadcast up to this size.
MAX_BYTES = 64 << 20
#: Copies of one text are dealt over so many tasks where texts are shuffled.
SALTS = 32
#: Terms with a larger part of all occurrences than 1 / HOT_SHARE are joined by
#: broadcast: there are HOT_SHARE of them at most.
HOT_SHARE = 100_000

# The patterns match what the plain ones match: possessive repeats where what
# follows cannot begin inside the repeat, and starts inside a run that fails
# at its first character left out.  So long runs take linear time and no
# recursion, and a number that is too short for a card is passed over.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9](?:[\x20-]?[0-9]){15})[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_GATES = {"email": "@", "ip": "[0-9][.][0-9]", "card": "[0-9]", "phone": "[+][0-9]"}
_BREAKS = r"\s\u00a0\u3000\u3001\u3002\uff01\uff08\uff09\uff0c\uff1a\uff1b\uff1f\u300a-\u3011"
_ENDS = ".,;:!?()[]{}<>'\"*\u2018\u2019\u201c\u201d\u00ab\u00bb\u2026"
_SET = "".join(f"\\{c}" if c.isascii() else c for c in _ENDS)
# white space with the punctuation on both sides; a run of punctuation is tried once
_GAP = f"(?:[{_SET}](?<![{_SET}][{_SET}])[{_SET}]*+)?+[{_BREAKS}][{_BREAKS}{_SET}]*+"
_TERM = r"^(?:(?=.*\p{L})[\p{L}\p{M}\p{N}_'\u2019-]{3,}|\p{IsHan}{2})$"
_SPAN = "struct<kind:string,start:int,end:int,value:string>"
_PLACE = "struct<kind:string,start:int,end:int>"
#: Arrays are scanned in chunks, so long ones take no quadratic time.
CHUNK = 512


def _luhn(digits: Column) -> Column:
    """Whether the digits' Luhn sum is a multiple of ten."""
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(i: Column) -> Column:
        d = F.substring(digits, F.negative(i), F.lit(1)).cast("int") * (2 - i % 2)
        return d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        short = lambda part: F.regexp_replace(part, "^0+", "")
        small = lambda part: (F.length(short(part)) < 3) | ((F.length(short(part)) == 3) & (short(part) <= "255"))
        return F.forall(F.split(value, "[.]"), small)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _chunks(array: Column) -> Column:
    places = F.sequence(F.lit(0), F.floor((F.size(array) - 1) / CHUNK).cast("int"))
    return F.transform(places, lambda c: F.slice(array, c * CHUNK + 1, F.lit(CHUNK)))


def _running(values: Column, combine, zero: int) -> Column:
    """For every element, ``combine`` of the integers before it."""
    none = F.array().cast("array<int>")
    start = F.struct(F.lit(zero).alias("at"), none.alias("out"))

    def inside(acc: Column, x: Column) -> Column:
        return F.struct(combine(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    own = F.transform(_chunks(values), lambda c: F.aggregate(c, start, inside))
    begin = F.struct(F.lit(zero).alias("at"), F.array().cast("array<array<int>>").alias("out"))

    def across(acc: Column, chunk: Column) -> Column:
        shifted = F.transform(chunk["out"], lambda v: combine(acc["at"], v))
        return F.struct(combine(acc["at"], chunk["at"]).alias("at"), F.concat(acc["out"], F.array(shifted)).alias("out"))

    return F.when(F.size(values) > 0, F.flatten(F.aggregate(own, begin, across)["out"])).otherwise(none)


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """Array of spans of all matches: the pieces between matches say where
    they are."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.arrays_zip(found.alias("m"), F.slice(between, 1, F.size(found)).alias("b"))
    lengths = F.transform(pairs, lambda x: F.length(x["b"]) + F.length(x["m"]))
    placed = F.arrays_zip(pairs.alias("x"), _running(lengths, lambda a, b: a + b, 0).alias("at"))

    def span(p: Column) -> Column:
        start = p["at"] + F.length(p["x"]["b"])
        end = start + F.length(p["x"]["m"])
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), p["x"]["m"].alias("value"))

    return F.transform(placed, span)


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end, value), by kind as listed, then by start."""
    empty = F.array().cast(f"array<{_SPAN}>")

    def of(kind: str) -> Column:
        spans = F.filter(_matches(text, PATTERNS[kind], kind), lambda s: _passes(kind, s["value"]))
        return F.when(text.rlike(_GATES[kind]), spans).otherwise(empty)

    return F.concat(*[of(kind) for kind in KINDS])


def _words(text: Column) -> Column:
    """Array of the distinct words of a text, ends dropped; those that
    ``_TERM`` does not match are left out later, once for the corpus."""
    return F.array_distinct(F.split(F.concat(F.lit(" "), F.lower(text), F.lit(" ")), _GAP, -1))


def _term_places(texts: DataFrame) -> DataFrame:
    """(digest, term, start, end) of every word of (digest, text)."""
    pieces = texts.select("digest", F.posexplode(F.split("text", f"[{_BREAKS}]", -1)).alias("pos", "piece"))
    before = Window.partitionBy("digest").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    piece, own = F.col("piece"), F.btrim("piece", F.lit(_ENDS))
    end = F.sum(F.length(piece) + 1).over(before) - 1
    start = (F.col("stop") - F.length(F.ltrim(piece, F.lit(_ENDS)))).cast("int")
    words = pieces.withColumn("stop", end).where(F.length(own) > 0)
    return words.select("digest", F.lower(own).alias("term"), start.alias("start"), (start + F.length(own)).alias("end"))


def _small(df: DataFrame, *columns: str) -> bool:
    """Whether a written table takes at most ``MAX_BYTES``; ``columns`` are
    its strings and arrays."""
    sizes = [F.size(c) * 16 if dict(df.dtypes)[c].startswith("array") else F.octet_length(c) for c in columns]
    return (df.agg(F.sum(sum(sizes, F.lit(48)))).first()[0] or 0) <= MAX_BYTES


def _by_digest(rows: DataFrame, keyed: DataFrame, how: str, *columns: str) -> DataFrame:
    """``rows`` joined with ``keyed`` (written, one row per digest): by
    broadcast, or with the copies of a text dealt over ``SALTS`` tasks."""
    if _small(keyed, *columns):
        return rows.join(F.broadcast(keyed), "digest", how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return salted.join(keyed.withColumn("salt", salts), ["digest", "salt"], how).drop("salt")


def _counted(words: DataFrame, terms: DataFrame) -> DataFrame:
    """``words`` with ``n_t`` of their term, of those in ``terms``."""
    if _small(terms, "term"):
        return words.join(F.broadcast(terms), "term")
    total = terms.agg(F.sum("n_t")).first()[0] or 0
    hot = F.broadcast(terms.where(F.col("n_t") * HOT_SHARE > total))
    rest = words.join(hot.select("term"), "term", "left_anti").join(terms, "term")
    return words.join(hot, "term").unionByName(rest)


def disclosures(rows: DataFrame, folder: str) -> DataFrame:
    """(entity, term, action): terms that give an entity away.  ``rows`` has
    ``text``, ``digest`` and ``base`` of the whole corpus."""
    copies = rows.groupBy("digest").agg(F.count("*").alias("copies")).where("copies > 1")
    copies = save(copies, folder)
    n = rows.count() - (copies.agg(F.sum(F.col("copies") - 1)).first()[0] or 0)
    # a text counts once: each of its copies for its share of one
    share = (1 / F.coalesce("copies", F.lit(1))).alias("share")
    used = _by_digest(rows.select("digest", _words(F.col("text")).alias("words")), copies, "left")
    terms = used.select(F.explode("words").alias("term"), share).groupBy("term").agg(F.round(F.sum("share")).cast("long").alias("n_t"))
    terms = save(terms.where(F.col("n_t") >= TOGETHER), folder).where(F.col("term").rlike(_TERM))

    entity = lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))
    texts = rows.where(F.size("base") > 0)
    texts = texts.select("digest", F.array_distinct(F.transform("base", entity)).alias("entities"), _words(F.col("text")).alias("words"))
    texts = save(texts.groupBy("digest").agg(F.first("entities").alias("entities"), F.first("words").alias("words")), folder)
    mentions = texts.select("digest", F.explode("entities").alias("entity"))
    entities = save(mentions.groupBy("entity").agg(F.count("*").alias("n_c")).where(F.col("n_c").between(TOGETHER, n - 1)), folder)
    held = save(mentions.join(F.broadcast(entities) if _small(entities, "entity") else entities, "entity"), folder)

    words = texts.join(held.select("digest").distinct(), "digest", "left_semi").select("digest", F.explode("words").alias("term"))
    most = F.col("n_c") * F.pow(F.lit(float(n)) / F.col("n_c"), F.lit(1 - GENERALISE)) * (1 + 1e-9)
    pairs = _counted(words, terms).join(held, "digest").where(F.col("n_t") <= most)
    pairs = pairs.groupBy("entity", "term", "n_c", "n_t").agg(F.count("*").alias("n_tc")).where(F.col("n_tc") >= TOGETHER)
    pmi = F.log2(F.lit(float(n)) * F.col("n_tc") / (F.col("n_t") * F.col("n_c")))
    told = pairs.select("entity", "term", pmi.alias("pmi"), F.log2(F.lit(float(n)) / F.col("n_c")).alias("ic"))
    told = told.where(F.col("pmi") >= GENERALISE * F.col("ic"))
    return told.select("entity", "term", F.when(F.col("pmi") >= REMOVE * F.col("ic"), "removed").otherwise("term").alias("action"))


def _term_spans(rows: DataFrame, told: DataFrame, folder: str) -> DataFrame:
    """(digest, terms): the spans of told terms in every text that has some."""
    # a term that tells of two entities counts once, by the stronger action
    told = save(told.groupBy("term").agg(F.min("action").alias("action")), folder)
    told = F.broadcast(told) if _small(told, "term") else told
    words = rows.select("digest", F.explode(_words(F.col("text"))).alias("term"))
    marked = save(words.join(told, "term", "left_semi").select("digest").distinct(), folder)
    texts = _by_digest(rows.select("digest", "text"), marked, "inner").groupBy("digest").agg(F.first("text").alias("text"))
    places = _term_places(texts)
    place = F.struct("start", "end", F.col("action").alias("kind"))
    spans = places.join(told, "term").groupBy("digest").agg(F.array_sort(F.collect_list(place)).alias("terms"))
    kinds = F.transform("terms", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return save(spans.select("digest", kinds.alias("terms")), folder)


def _with_spans(df: DataFrame, text_col: str, folder: str) -> DataFrame:
    """(row, base, terms): every row of ``df`` with its arrays of spans."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("digest")
    rows = df.select(text.alias("text"), digest, base_spans(text).alias("base"))
    told = save(disclosures(rows, folder), folder)
    spans = _term_spans(rows, told, folder)
    places = F.transform(base_spans(text), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), digest, places.alias("base"))
    out = _by_digest(out, spans, "left", "terms")
    return out.select("row", "base", F.coalesce("terms", F.array().cast(f"array<{_PLACE}>")).alias("terms"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = _with_spans(rows, "text", shared_folder(df.sparkSession))
    base, terms = F.col("base"), F.col("terms")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in KINDS]
    return rows.select("row.doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.concat(base, terms)).alias("spans"))


def _merged(spans: Column) -> Column:
    """Spans by start, those that overlap as one of the first and longest
    one's kind."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus"), s["kind"].alias("kind"))))
    ordered = F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), (-s["minus"]).alias("end"), s["kind"].alias("kind")))
    ends = F.transform(ordered, lambda s: s["end"])
    reached = F.arrays_zip(ordered.alias("s"), _running(ends, lambda a, b: F.greatest(a, b), -1).alias("before"))
    first = F.filter(reached, lambda r: r["s"]["start"] >= r["before"])

    def whole(r: Column, i: Column) -> Column:
        end = F.coalesce(F.get(F.transform(first, lambda f: f["before"]), i + 1), F.array_max(ends))
        return F.struct(r["s"]["start"].alias("start"), end.alias("end"), r["s"]["kind"].alias("kind"))

    return F.transform(first, whole)


def _replaced(text: Column, spans: Column) -> Column:
    """The text with its sorted, disjoint spans replaced, chunk by chunk."""
    word = lambda s: F.when(s["kind"] == "removed", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    def chunk(own: Column, c: Column) -> Column:
        begin = F.when(c > 0, F.get(spans, c * CHUNK - 1)["end"]).otherwise(0)
        region = F.substring(text, begin + 1, F.element_at(own, -1)["end"] - begin)

        def piece(s: Column, i: Column) -> Column:
            at = F.when(i > 0, F.get(own, i - 1)["end"]).otherwise(begin)
            return F.concat(F.substring(region, at - begin + 1, s["start"] - at), word(s))

        return F.array_join(F.transform(own, piece), "")

    tail = F.substring(text, F.element_at(spans, -1)["end"] + 1, F.length(text))
    return F.concat(F.array_join(F.transform(_chunks(spans), chunk), ""), tail)


def sanitise(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``df`` with its texts sanitised: base spans and generalised terms give
    way to their kind in brackets, removed terms to nothing; ``length_col``,
    where there is one, is the new length."""
    spans, text = F.col("spans"), F.col(f"row.`{text_col}`")
    rows = _with_spans(df, text_col, shared_folder(df.sparkSession)).select("row", _merged(F.concat("base", "terms")).alias("spans"))
    rows = rows.withColumn("cleaned", F.when(F.size(spans) > 0, _replaced(text.cast("string"), spans)).otherwise(text))
    out = []
    for field in df.schema:
        own = F.col(f"row.`{field.name}`")
        if field.name == text_col:
            own = F.col("cleaned")
        elif field.name == length_col:
            own = F.when(F.size(spans) > 0, F.length("cleaned")).otherwise(own).cast(field.dataType)
        out.append(own.alias(field.name))
    return rows.select(*out)
