"""Personal data: spans by pattern, and terms that give their owners away, in DataFrame operations.

Base spans are emails, IP addresses, payment cards and phone numbers. A term (a word near one) is
added where it discloses the entity. Over all documents, with N documents, n(e) that hold entity e, n(t)
that hold term t and n(e, t) that hold t within ``NEAR`` characters of e,

    disclosure(e, t) = log(n(e, t) N / (n(e) (n(t) + SMOOTH))) / log(N / n(e))

is the mutual information of the two over what there is to know about e, as if ``SMOOTH`` more documents
held t without e. It nears 1 where t occurs with e alone, the more so the rarer t is among the documents,
so an entity of one document is judged too. Terms of ``SUPPORT`` documents with e and a disclosure of
``DISCLOSED`` or more are spans of kind term wherever they stand, in any document.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from newsloom.llm.components import _written
from newsloom.llm.lines import NO_KEY, bound

NEAR = 100
SUPPORT = 1
SMOOTH = 1
DISCLOSED = 0.8
SHORTEST_TERM = 4
SENT = 100_000  # terms up to which their list is broadcast

# The given patterns, without nested loops: Java's engine recurses on those and overflows on long runs.
# A start lies at a run's beginning or where the last match ended, so a run is not tried at every place.
_USER, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
EMAIL = rf"(?:(?<![{_USER}])|\G)[{_USER}]++@(?=[{_HOST}]++\.[{_HOST}])(?:[{_HOST}.](?<!\.(?![{_HOST}])))++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[0-9 -](?<![ -](?![0-9])))++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _identified(docs, key, text):
    full = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("k"), F.xxhash64(full).alias("t"), full.alias("text"))


def _digits(value):
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits):
    n = F.length(digits)
    values = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, (n - i + 1).cast("int"), F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(values, F.lit(0), lambda total, x: total + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _holds(kind, value):
    """Whether a match of the pattern is one of its kind."""
    digits = _digits(value)
    parts = F.transform(F.split(value, r"\."), lambda x: F.regexp_replace(x, "^0+", ""))
    return (
        F.when(kind == "ip", F.forall(parts, lambda x: (F.length(x) <= 3) & (F.coalesce(x.try_cast("int"), F.lit(0)) <= 255)))
        .when(kind == "card", F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", F.length(digits).between(8, 15))
        .otherwise(True)
    )


def _around(hits, gaps, i, side):
    """Up to NEAR + 1 characters of the whole text before (after) match i; a match has two characters or more."""
    reach = NEAR // 2 + 1
    low = F.greatest(i - reach, F.lit(0)) if side == "before" else i + 1
    count = (i - low if side == "before" else F.least(F.lit(reach), F.size(hits) - low)).cast("int")
    pieces = F.arrays_zip(F.slice(gaps, low + 1, count).alias("gap"), F.slice(hits, low + 1, count).alias("hit"))
    joined = F.array_join(F.transform(pieces, lambda x: F.concat(x["gap"], x["hit"])), "")
    last = F.get(gaps, low + count)
    text = F.concat(joined, last)
    return F.right(text, F.lit(NEAR + 1)) if side == "before" else F.left(text, F.lit(NEAR + 1))


def _matches(text, kind, pattern):
    """Matches of one kind as structs; null where the text has none. Only those of their kind have contexts."""
    found = bound(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda hits: F.when(
            F.size(hits) > 0,
            bound(
                F.split(text, pattern, -1),
                lambda gaps: F.transform(
                    F.transform(hits, lambda hit: F.struct(hit.alias("value"), _holds(F.lit(kind), hit).alias("holds"))),
                    lambda x, i: F.struct(
                        F.lit(kind).alias("kind"),
                        i.alias("i"),
                        x["value"].alias("value"),
                        x["holds"].alias("holds"),
                        F.length(F.get(gaps, i)).alias("gap"),
                        F.when(x["holds"], _around(hits, gaps, i, "before")).alias("before"),
                        F.when(x["holds"], _around(hits, gaps, i, "after")).alias("after"),
                    ),
                ),
            ),
        ),
    )
    return F.when(F.contains(text, F.lit("@")), found) if kind == "email" else found


def base_spans(docs, key="doc_id", text="text"):
    """k, t (which tell a row's text), kind, value, start, end and the text around every base span.

    Equal rows have their spans once; a null or empty text has none.
    """
    found = F.concat(*(F.coalesce(_matches(F.col("text"), *x), F.array()) for x in KINDS.items()))
    hits = _identified(docs, key, text).select("k", "t", F.explode(found).alias("m")).select("k", "t", "m.*")
    in_order = Window.partitionBy("k", "t", "kind").orderBy("i")
    placed = (
        hits.dropDuplicates(["k", "t", "kind", "i"])
        .withColumn("end", F.sum(F.col("gap") + F.length("value")).over(in_order))
        .withColumn("start", F.col("end") - F.length("value"))
    )
    return placed.filter("holds").drop("i", "holds", "gap")


def _words(context):
    """Words of a short text with their places: structs of term and at."""
    hits = F.regexp_extract_all(context, F.lit(WORD), F.lit(0))
    gaps = F.split(context, WORD, -1)
    empty = F.array().cast("array<struct<term: string, at: int>>")
    return F.aggregate(
        F.arrays_zip(hits.alias("hit"), F.slice(gaps, F.lit(1), F.size(hits)).alias("gap")),
        F.struct(F.lit(0).alias("at"), empty.alias("found")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.concat(acc["found"], F.array(F.struct(x["hit"].alias("term"), (acc["at"] + F.length(x["gap"])).alias("at")))).alias("found"),
        ),
        lambda acc: acc["found"],
    )


def _entity():
    digits = F.when(F.col("kind") == "ip", F.col("value")).otherwise(_digits(F.col("value")))
    return F.concat_ws(":", "kind", F.when(F.col("kind") == "email", F.lower("value")).otherwise(digits))


def _near_terms(spans):
    """k, t, entity, term of the whole words of the text that lie within NEAR characters of each base span."""
    # a word at the far edge of NEAR + 1 characters is cut or too far; one that touches the span is part of a longer one
    ends = lambda part: F.col("value").rlike(part)
    n = F.length("before")
    left = F.filter(
        _words(F.col("before")),
        lambda w: ((w["at"] > 0) | (n <= NEAR)) & ((w["at"] + F.length(w["term"]) < n) | ~ends(rf"\A{WORD}")),
    )
    right = F.filter(
        _words(F.col("after")),
        lambda w: ((w["at"] + F.length(w["term"]) <= NEAR) | (F.length("after") <= NEAR)) & ((w["at"] > 0) | ~ends(rf"{WORD}\z")),
    )
    words = spans.select("k", "t", _entity().alias("entity"), F.explode(F.concat(left, right)["term"]).alias("w"))
    return words.filter(F.length("w") >= SHORTEST_TERM).select("k", "t", "entity", F.lower("w").alias("term"))


def _distinct_words(text):
    return F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))


def _weights(docs, key, text):
    """(text, weight) of every row; the rows of one key and text weigh one together."""
    rows = _identified(docs, key, text).select("k", "t", "text")
    repeated = _written(rows.groupBy("k", "t").agg(F.count("*").alias("copies")).filter("copies > 1"), "repeated")
    n = repeated.count()
    if not n:
        return rows.select("text", F.lit(1.0).alias("weight"))
    repeated = F.broadcast(repeated) if n <= SENT else repeated
    return rows.join(repeated, ["k", "t"], "left").select("text", (1 / F.coalesce("copies", F.lit(1))).alias("weight"))


def disclosing(docs, spans, terms, key="doc_id", text="text", support=SUPPORT, disclosed=DISCLOSED):
    """entity, term, disclosure of the pairs at or over the thresholds; counts are over all documents.

    Rows of equal key and text count once, here as well as in ``spans`` and ``terms``.
    """
    holds = spans.select("k", "t", _entity().alias("entity"))
    of_entity = holds.distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    together = terms.select("entity", "term", "k", "t").distinct().groupBy("entity", "term").agg(F.count("*").alias("n_et")).filter(F.col("n_et") >= support)
    weighed = _weights(docs, key, text)
    seen = _distinct_words(F.lower(F.coalesce(F.col("text"), F.lit(""))))
    # sums of shares of one are whole numbers but for rounding
    n_t = F.round(F.sum("weight")).cast("long").alias("n_t")
    of_term = weighed.select("weight", F.explode(seen).alias("term")).filter(F.length("term") >= SHORTEST_TERM).groupBy("term").agg(n_t)
    total = weighed.agg(F.round(F.sum("weight")).cast("long").alias("n"))
    pairs = together.join(of_term, "term").join(of_entity, "entity").crossJoin(F.broadcast(total))  # one row
    shared = F.log(F.col("n_et") * F.col("n") / (F.col("n_e") * (F.col("n_t") + SMOOTH))) / F.log(F.col("n") / F.col("n_e"))
    return pairs.filter(F.col("n") > F.col("n_e")).select("entity", "term", shared.alias("disclosure")).filter(F.col("disclosure") >= disclosed)


def _occurrences(docs, terms, key, text):
    """k, t, start, end of every place of the terms in the texts, near an entity or not.

    Words of the texts find the terms; the found words, as they are written, are one pattern a text.
    """
    rows = _identified(docs, key, text)
    words = rows.select("k", "t", F.explode(_distinct_words(F.col("text"))).alias("w")).filter(F.length("w") >= SHORTEST_TERM)
    listed = F.broadcast(terms) if terms.count() <= SENT else terms
    held = words.withColumn("term", F.lower("w")).join(listed, "term", "left_semi").groupBy("k", "t").agg(F.collect_set("w").alias("w"))
    # words are digits, letters and non-ASCII characters only, so they need no quoting
    alone = F.lit(WORD[:-1])
    pattern = F.concat(F.lit("(?<!"), alone, F.lit(")(?:"), F.array_join("w", "|"), F.lit(")(?!"), alone, F.lit(")"))
    found = bound(
        pattern,
        lambda p: F.arrays_zip(
            F.transform(F.regexp_extract_all("text", p, F.lit(0)), F.length).alias("size"), F.transform(F.split("text", p, -1), F.length).alias("gap")
        ),
    )
    hits = rows.join(held, ["k", "t"]).select("k", "t", F.posexplode(found).alias("i", "m")).filter("m.size IS NOT NULL")
    in_order = Window.partitionBy("k", "t").orderBy("i")
    placed = hits.dropDuplicates(["k", "t", "i"]).withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(in_order))
    return placed.select("k", "t", (F.col("end") - F.col("m.size")).alias("start"), "end")


def all_spans(docs, key="doc_id", text="text", support=SUPPORT, disclosed=DISCLOSED):
    """k, t, kind, start, end of base spans and of all places of disclosing terms, each span once."""
    spans = base_spans(docs, key, text)
    pairs = disclosing(docs, spans, _near_terms(spans), key, text, support, disclosed)
    terms = _written(pairs.select("term").distinct(), "terms")
    given = _occurrences(docs, terms, key, text).select("k", "t", F.lit("term").alias("kind"), "start", "end")
    return spans.select("k", "t", "kind", "start", "end").unionByName(given)


def find(docs, key="doc_id", text="text", support=SUPPORT, disclosed=DISCLOSED):
    """key and spans, an array of (kind, start, end) by kind as listed, term last, then place, for every row.

    Places are code points, the end exclusive. Repeated rows have the same spans; a null or empty text none.
    """
    order = F.array_position(F.array(*(F.lit(x) for x in (*KINDS, "term"))), F.col("kind"))
    grouped = (
        all_spans(docs, key, text, support, disclosed)
        .groupBy("k", "t")
        .agg(F.array_sort(F.collect_list(F.struct(order.alias("order"), "start", "end", "kind"))).alias("s"))
    )
    rows = docs.select(F.col(key), F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    found = F.transform(F.coalesce("s", F.array()), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return rows.join(grouped, ["k", "t"], "left").select(key, found.alias("spans"))


def sanitise(docs, key="doc_id", text="text", support=SUPPORT, disclosed=DISCLOSED):
    """``docs``, all columns, with base spans generalised to their kind and disclosing terms to number or term.

    Where spans overlap, the one that begins first (the longer of two) covers the others' common part.
    """
    spans = all_spans(docs, key, text, support, disclosed)
    before = Window.partitionBy("k", "t").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    cut = spans.withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0))).filter(F.col("end") > F.col("reach"))
    cut = cut.withColumn("start", F.greatest("start", "reach")).groupBy("k", "t").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("cut"))
    # the columns of docs are numbered, so that none has an inner name
    names = {c: f"c_{i}" for i, c in enumerate(docs.columns)}
    k, t = F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t")
    joined = docs.select(k, t, *(F.col(c).alias(n) for c, n in names.items())).join(cut, ["k", "t"], "left")
    own_text = F.col(names[text])

    def label(c):
        own = F.substring(own_text, (c["start"] + 1).cast("int"), (c["end"] - c["start"]).cast("int"))
        named = F.when(c["kind"] != "term", F.upper(c["kind"])).when(own.rlike("^[0-9]+$"), "NUMBER").otherwise("TERM")
        return F.concat(F.lit("["), named, F.lit("]"))

    def gap(i):
        start = F.when(i > 0, F.get(F.col("cut"), i - 1)["end"]).otherwise(0)
        stop = F.coalesce(F.get(F.col("cut"), i)["start"], F.length(own_text))
        return F.substring(own_text, (start + 1).cast("int"), (stop - start).cast("int"))

    parts = F.transform(F.sequence(F.lit(0), F.size("cut")), lambda i: F.concat(gap(i), F.when(i < F.size("cut"), label(F.get(F.col("cut"), i))).otherwise("")))
    new = F.when(F.col("cut").isNotNull(), F.array_join(parts, "")).otherwise(own_text)
    return joined.select(*(new.alias(c) if c == text else F.col(n).alias(c) for c, n in names.items()))
