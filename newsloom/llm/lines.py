"""Line dedup: a segment-partition edit join in DataFrame operations.

Lines are compared without the white space around them; blank lines are never compared. A line is
dropped where the same line, or one near it, stands earlier (by key, then place).

* Equal lines meet by 127 bits of hash; the first one stands for them.
* How many edits count as near follows from the shorter line: one from ``FROM[0]`` characters on, two from
  ``FROM[1]``. A shorter line is near nothing but itself, since an edit there is another word.
* First lines are cut into segments, one more than their edits: two lines within the edits agree in a
  segment, up to a small shift. Each line enters its segments, under its length, in an index and probes it
  with the substrings that segments of its length or less can have come to.
* Lines that meet lose all that they share at both ends. What is left of two lines two edits apart is the same but for its ends;
  where it is, the edit distance is taken in a band of diagonals, all cells of a column in one word.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

FROM = (8, 24)
EDITS = len(FROM)


def bound(value, use):
    """use(value) with value computed once a row."""
    return F.get(F.transform(F.array(value), use), 0)


def allowed(n):
    """The edits within which a line of n characters is near a line of as many or more."""
    return sum((F.when(n >= least, 1).otherwise(0) for least in FROM[1:]), F.when(n >= FROM[0], 1).otherwise(0))


def shifts(edits):
    """(length difference, segment, shift) of the substrings that a line probes (multi-match-aware)."""
    out = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            low, high = max(-i, less - (edits - i)), min(i, less + (edits - i))
            out += [(less, i, shift) for shift in range(low, high + 1)]
    return out


#: (segment, shift) of all substrings that any line probes
_PROBES = sorted({(i, shift) for edits in range(1, EDITS + 1) for _, i, shift in shifts(edits)})


def _entries(lines):
    """key and tag of the substrings of lines (h, line, n) that another's segments may equal.

    A tag is twice the line's h, and one more where the substring is a segment of the line itself.
    """
    # Steps of few expressions each: one large one would be too long a method to be compiled.
    cut = (
        lines.select("h", "line", "n", F.explode(F.array(*map(F.lit, range(EDITS + 1)))).alias("less"))
        .withColumn("m", F.col("n") - F.col("less"))
        .withColumn("e", allowed(F.col("m")))
        .filter("e > 0 AND less <= e")
        .withColumn("size", F.expr("int(m div (e + 1))"))
        .withColumn("plain", F.expr("e + 1 - m % (e + 1)"))  # the first segments, of that size; the others are one longer
    )
    keys = []
    for i, shift in _PROBES:
        start = f"size * {i} + greatest(0, {i} - plain) + {shift}"
        size = f"size + int({i} >= plain)"
        inside = f"{start} >= 0 AND {start} + {size} <= n" if shift else "true"
        low, high = f"greatest(-{i}, less - e + {i})", f"least({i}, less + e - {i})"
        keys.append(F.expr(f"CASE WHEN {i} <= e AND {shift} BETWEEN {low} AND {high} AND {inside} THEN xxhash64(m, {i}, substring(line, {start} + 1, {size})) END"))
    own = [k for k, (_, shift) in enumerate(_PROBES) if shift == 0]
    tag = F.shiftleft("h", 1).bitwiseOR(((F.col("less") == 0) & F.col("at").isin(own)).cast("long"))
    found = cut.select("h", "less", F.posexplode(F.array(*keys)).alias("at", "key"))
    return found.filter("key IS NOT NULL").select("key", tag.alias("tag"))


def _distance(a, b, n_a, n_b):
    """Edits from the characters a to b, if they are few; n_b is n_a to n_a + EDITS, and not 0.

    Bit t of a word is the row that lies WIDTH - 1 - t above the lowest row of the band, which goes down one
    row a column. vp and vn hold where a cell is one more or one less than the cell above it; the distance
    is followed along the band's lower edge, then along the last row.
    """
    width, low = 2 * EDITS + 2, 2 * EDITS + 1
    full = (1 << width) - 1
    invert = lambda x: F.lit(full).bitwiseXOR(x.bitwiseAND(full))

    def column(state, j):
        char = F.get(b, j)
        equal = sum((F.when(F.get(a, j + (EDITS - low + t)) == char, 1 << t).otherwise(0) for t in range(1, width)), F.when(F.get(a, j + (EDITS - low)) == char, 1).otherwise(0))

        def moved(x):
            vp, vn = state["vp"], state["vn"]
            d0 = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(full)

            def moved_on(d):
                sides = F.struct(vn.bitwiseOR(invert(d.bitwiseOR(vp))).alias("hp"), d.bitwiseAND(vp).alias("hn"))

                def done(h):
                    down = F.shiftrightunsigned(d, 1)
                    # the last row stands one bit higher in each column after it was reached
                    bit = F.call_function("shiftleft", F.lit(1), (F.lit(low - 1) - (j - (n_a - EDITS))).cast("int"))
                    edge = F.when(d.bitwiseAND(1 << low) == 0, 1).otherwise(0)
                    row = F.when(h["hp"].bitwiseAND(bit) != 0, 1).when(h["hn"].bitwiseAND(bit) != 0, -1).otherwise(0)
                    return F.struct(
                        h["hn"].bitwiseOR(invert(down.bitwiseOR(h["hp"]))).alias("vp"),
                        down.bitwiseAND(h["hp"]).alias("vn"),
                        (state["distance"] + F.when(j < n_a - EDITS, edge).otherwise(row)).alias("distance"),
                    )

                return bound(sides, done)

            return bound(d0, moved_on)

        # the distance falls by one a column at most, in at most 2 * EDITS columns
        return F.when(state["distance"] > 3 * EDITS, state).otherwise(bound(equal, moved))

    start = F.struct(F.lit(full & ~((1 << (low - EDITS)) - 1)).alias("vp"), F.lit(0).alias("vn"), F.least(n_a, F.lit(EDITS)).alias("distance"))
    return F.aggregate(F.sequence(F.lit(0), n_b - 1), start, column, lambda state: state["distance"])


def _shared(a, b, n, tail):
    """How many characters the lines share at their beginning (``tail``: end), n at most: the bits of that number, highest first."""

    def grown(found, k):
        part = lambda x: F.substring(x, (F.length(x) - found - k if tail else found) + 1, k)
        return F.when((k <= n - found) & (part(a) == part(b)), found + k).otherwise(found)

    return F.aggregate(F.array(*(F.lit(1 << bit) for bit in reversed(range(31)))), F.lit(0), grown)


def _trimmed(a, b):
    """The two lines as a struct, without all that they share at both ends; b has as many characters as a, or more."""

    def cut(head, tail):
        inner = lambda x: F.substring(x, head + 1, F.length(x) - head - tail)
        return F.struct(inner(a).alias("a"), inner(b).alias("b"))

    return bound(_shared(a, b, F.length(a), False), lambda head: bound(_shared(a, b, F.length(a) - head, True), lambda tail: cut(head, tail)))


def _edited_at_ends(a, b, n, m):
    """False only where trimmed lines, of n and m >= n characters, are more than two edits apart.

    Their first characters differ and so do their last, so one edit stands at either end: a character changed, or
    one more in a or in b. What lies between must be the same.
    """
    inner = lambda x, size, left, right: F.substring(x, F.lit(left + 1), size - left - right)
    same = lambda a_left, a_right, b_left, b_right: inner(a, n, a_left, a_right) == inner(b, m, b_left, b_right)
    more = m - n
    return (
        F.when(more == 0, same(1, 1, 1, 1) | same(0, 1, 1, 0) | same(1, 0, 0, 1))
        .when(more == 1, same(0, 1, 1, 1) | same(1, 0, 1, 1))
        .otherwise(same(0, 0, 1, 1))
    )


PIECES = 6


def _pieces(line, n):
    """The line in ``PIECES`` parts; an edit spoils one of them at most, the others stand in the edited line."""
    cut = lambda i: F.floor(n * i / PIECES).cast("int")
    return F.array(*(F.substring(line, cut(i) + 1, cut(i + 1) - cut(i)) for i in range(PIECES)))


def _may_be_near(pieces, n, b):
    """False only where so many pieces are missing in b that the line they make up is not near it."""
    return F.size(F.filter(pieces, lambda piece: F.contains(b, piece))) >= F.lit(PIECES) - allowed(n)


def _near(a, b):
    """Whether line b, of as many characters as a or up to EDITS more, is within the edits allowed to a."""

    def rest(both):
        n, m = F.length(both["a"]), F.length(both["b"])
        # a shared end changes no distance; without characters in one the other's are all inserted
        out = F.when(n == 0, m)
        if EDITS <= 2:
            out = out.when(~_edited_at_ends(both["a"], both["b"], n, m), EDITS + 1)
        return out.otherwise(_distance(F.split(both["a"], ""), F.split(both["b"], ""), n, m))

    return bound(_trimmed(a, b), rest) <= allowed(F.length(a))


NO_KEY = -(1 << 63)  # stands for a null key, so that such rows come first


def _identified(docs, key, text):
    """All columns but the key, and k and t, which tell a row's text: equal rows share them."""
    others = [F.col(c).alias(f"c_{i}") for i, c in enumerate(docs.columns) if c not in (key, text)]
    own = F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t")
    return docs.select(*own, F.col(text).alias("text"), *others)


def _lines():
    return F.split(F.coalesce("text", F.lit("")), "\n", -1)


def _compared_form(line):
    return F.btrim(line, F.lit(" \t\r\f\v"))


def _line_name(line):
    """63 bits, so that one is left for a mark."""
    return F.shiftrightunsigned(F.xxhash64(line), 1)


def _first_lines(rows):
    """h (hash), k, t and pos of the first of each set of equal lines; equality by two hashes."""
    lines = F.transform(_lines(), lambda x, i: F.struct(_compared_form(x).alias("line"), i.alias("pos")))
    return (
        rows.select("k", "t", F.explode(lines).alias("x"))
        .filter("x.line != ''")
        .select(_line_name(F.col("x.line")).alias("h"), F.xxhash64(F.lit(1), "x.line").alias("h2"), F.struct("k", "t", "x.pos").alias("at"))
        .groupBy("h", "h2")
        .agg(F.min("at").alias("at"))
        .select("h", "at.*")
    )


def _near_lines(firsts, docs_lines, block):
    """k, t and pos of first lines with an earlier first line that is near.

    ``docs_lines``: k, t, text, firsts (positions). Lines that share a key are collected in blocks of
    about ``block`` lines and blocks are compared, so a key of many lines gives few rows, none a pair.
    """
    lines = docs_lines.select(
        F.explode(
            bound(_lines(), lambda x: F.transform("firsts", lambda pos: _compared_form(F.get(x, pos))))
        ).alias("line")
    ).select(_line_name(F.col("line")).alias("h"), "line", F.char_length("line").alias("n"))
    same = Window.partitionBy("key")
    met = (
        _entries(lines)
        .withColumns({"h": F.shiftrightunsigned("tag", 1), "own": F.col("tag").bitwiseAND(1)})
        .select(
            "h",
            "key",
            "own",
            F.min("h").over(same).alias("low"),
            F.max("h").over(same).alias("high"),
            F.sum("own").over(same).alias("n_own"),
            F.count("*").over(same).alias("n_all"),
        )
        .filter("low < high AND n_own > 0")
    )
    # a segment stands on both sides: the index and the probes
    sides = F.array_compact(F.array(F.struct(F.lit(False).alias("index"), F.col("n_all").alias("size")), F.when(F.col("own") == 1, F.struct(F.lit(True).alias("index"), F.col("n_own").alias("size")))))
    met = met.select("h", "key", F.explode(sides).alias("s")).select(
        "h", "key", "s.index", F.pmod(F.xxhash64("h", F.lit(3)), F.ceil(F.col("s.size") / block)).alias("block")
    )
    placed = (
        met.join(firsts, "h")
        .join(docs_lines.select("k", "t", "text"), ["k", "t"])
        .select("key", "index", "block", F.struct("k", "t", "pos").alias("at"), _compared_form(F.get(_lines(), F.col("pos"))).alias("line"))
        .select("key", "index", "block", F.struct("at", "line", F.char_length("line").alias("n")).alias("x"))
    )
    # sides are told by an aggregate: a filter on ``index`` would be pushed down, and the entries sorted twice
    blocks = placed.groupBy("key", "index", "block").agg(F.collect_set("x").alias("x"), F.max("index").alias("side"))
    left = blocks.filter("side").select("key", F.col("x").alias("a"))
    right = blocks.filter("NOT side").select("key", F.col("x").alias("b"))
    cut = lambda x: F.struct(x["at"].alias("at"), x["line"].alias("line"), x["n"].alias("n"), _pieces(x["line"], x["n"]).alias("pieces"))
    # the later line of each pair within reach
    alike = lambda a, b: (b["n"] - a["n"]).between(0, allowed(a["n"])) & _may_be_near(a["pieces"], a["n"], b["line"])
    near = lambda a, b: (a["at"] != b["at"]) & alike(a, b) & _near(a["line"], b["line"])
    found = lambda a: F.transform(F.filter("b", lambda b: near(a, b)), lambda b: F.greatest(a["at"], b["at"]))
    later = F.flatten(F.transform("a", lambda a: bound(cut(a), found)))
    return left.join(right, "key").select(F.explode(F.array_distinct(later)).alias("at")).select("at.*").distinct()


def drop_repeated(docs, key="doc_id", text="text", block=64):
    """``docs``, all columns, with repeated lines dropped from ``text``, and n_lines, n_same, n_near counts.

    n_lines: lines that are not blank; n_same of them are dropped as equal to an earlier line, n_near as
    near one. Blank lines stay. A text that loses nothing stays as it is, null too; one whose lines all
    go becomes what its blank lines are. Equal rows (same key and text) share their lines' places, so
    they keep the same lines; a null key counts as the least.
    """
    rows = _identified(docs, key, text)
    firsts = _first_lines(rows)
    of_row = firsts.groupBy("k", "t").agg(F.array_sort(F.collect_list("pos")).alias("firsts"))
    near = _near_lines(firsts, rows.join(of_row, ["k", "t"]), block)
    near = near.groupBy("k", "t").agg(F.collect_set("pos").alias("near"))
    none = F.array().cast("array<int>")
    joined = (
        rows.join(of_row, ["k", "t"], "left")
        .join(near, ["k", "t"], "left")
        .withColumns({"firsts": F.coalesce("firsts", none), "near": F.coalesce("near", none)})
    )

    def kept(lines):
        blank = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: _compared_form(F.get(lines, i)) == "")
        stay = F.array_sort(F.concat(F.array_except("firsts", "near"), blank))
        return F.struct(
            F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n").alias("text"),
            (F.size(lines) - F.size(blank)).cast("long").alias("n_lines"),
            (F.size(lines) == F.size(stay)).alias("whole"),
        )

    done = joined.withColumn("kept", bound(_lines(), kept))
    new = F.when(F.col("kept.whole"), F.col("text")).otherwise(F.col("kept.text"))
    own = F.when(F.col("k") != NO_KEY, F.col("k")).cast(dict(docs.dtypes)[key])
    back = {key: own, text: new}
    return done.select(
        *(back.get(c, F.col(f"c_{i}")).alias(c) for i, c in enumerate(docs.columns)),
        F.col("kept.n_lines").alias("n_lines"),
        (F.col("kept.n_lines") - F.size("firsts")).cast("long").alias("n_same"),
        F.size("near").cast("long").alias("n_near"),
    )
