r"""Line dedup: exact copies by hash, near copies by a segment-partition edit join.

Lines (texts cut at ``\n``) are duplicates when they are equal, or when both
have at least ``min_chars`` characters and their edit distance is at most
``edits``; duplicates of duplicates share a class, named by its first line.

The join cuts every line of length l into edits + 1 even segments and keeps each
under (l, segment number, segment's text).  Two lines within the distance agree on
one segment, shifted by at most the edits around it, so a line of length L
probes, for each length from L - edits to L, only the substrings whose start
differs by no more than the edits that can stand before and after
them.  Keys are 64-bit hashes; only keys of two or more lines go on.  Candidates
are verified by the banded bit-parallel recurrence: the 2 * edits + 1 diagonals of
a column are the bits of one long, and a column is advanced by a few logical
operations and one addition.

Before that, pairs are ruled out by their counts of ``COUNTED`` characters, two longs a line
that shares a key: an edit changes two counts by one at most, so counts that differ by more than
twice the edits cannot link. Such a pair is never made a row, not even in a bucket that
many lines share which are no near copies of each other.

Everything is DataFrame functions.  Line texts are not shuffled: rows carry 64-bit
line hashes, and only texts of lines that share a key are fetched, once each.  Buckets
are resolved without listing their pairs (``buckets.connect``); copies count as one
line from the first aggregation on.

Defined results: blank lines (no characters but white space) are never
duplicates; null text has no lines; rows that repeat a doc_id hold their lines
again (same number, so the copies share a place and are all kept or all
dropped); null doc_ids come first.  Lines under ``min_chars`` are duplicates only
when equal.  Exact classes use 128 bits of hash, the edit join 64.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dssforge.llm.buckets import connect, ends
from dssforge.llm.store import Scratch, few, fewer_tasks, small

EDITS, MIN_CHARS = 2, 30
#: Share of all lines from which on a class is met by broadcast; at most 1 / HOT_SHARE classes are.
HOT_SHARE = 1 / 10_000


#: Characters that are counted, eight to a long (a count of more than 255 stands as 255).
COUNTED = " etaonirshldcum."


def histogram(line: Column) -> Column:
    """Counts of the ``COUNTED`` characters of a line, as a struct of two longs."""
    size = F.length(line)

    def packed(characters: str) -> Column:
        lanes = [F.shiftleft(F.least(size - F.length(F.replace(line, F.lit(x), F.lit(""))), F.lit(255)).cast("long"), 8 * i) for i, x in enumerate(characters)]
        return reduce(lambda a, b: a.bitwiseOR(b), lanes)

    return F.struct(packed(COUNTED[:8]).alias("lo"), packed(COUNTED[8:]).alias("hi"))


def may_be_near(edits: int):
    """Whether two histograms differ by no more than ``edits`` can change."""

    def near(a: Column, b: Column) -> Column:
        lanes = [F.abs(F.shiftrightunsigned(a[k], 8 * i).bitwiseAND(F.lit(255)) - F.shiftrightunsigned(b[k], 8 * i).bitwiseAND(F.lit(255))) for k in ("lo", "hi") for i in range(8)]
        return reduce(lambda x, y: x + y, lanes) <= 2 * edits

    return near


def lines_of(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, line_no, line) of the nonblank lines; line_no counts all lines from 0."""
    cut = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
    return cut.where(F.trim(F.col("line"), F.lit(" \t\r\x0b\x0c")) != "")


def _probes(edits: int) -> list[tuple[int, int, int, bool]]:
    """(characters the partner is shorter by, segment number, shift of its start, own segment) of each key of a line."""
    out = []
    for shorter in range(edits + 1):
        for number in range(edits + 1):
            before, after = number, edits - number  # edits that can stand on either side
            for shift in range(max(-before, shorter - after), min(before, shorter + after) + 1):
                out.append((shorter, number, shift, shorter == 0 and shift == 0))
    return out


def keys(lines: DataFrame, edits: int) -> DataFrame:
    """(h, key, anchor) of lines (h, codes, n): the line's own segments as anchors, and the substrings it probes with.

    ``codes`` is the line in UTF-32, where a substring is found without
    walking over the characters before it; ``n`` is its number of characters.
    A segment is one character longer from the number on at which an uneven
    length is made up.
    """
    probe = F.explode(F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in zip(("shorter", "number", "shift", "own"), p))) for p in _probes(edits))))
    rows = lines.select("h", "codes", "n", probe.alias("p"))
    length, number = F.col("n") - F.col("p.shorter"), F.col("p.number")
    rows = rows.select("h", "codes", "n", "p", length.alias("length"), (F.floor(length / (edits + 1)).cast("int")).alias("size"), (edits + 1 - length % (edits + 1)).alias("short"))
    start = F.col("size") * number + F.greatest(F.lit(0), number - F.col("short")) + 1 + F.col("p.shift")
    size = F.when(number >= F.col("short"), F.col("size") + 1).otherwise(F.col("size"))
    rows = rows.select("h", "codes", "n", "length", number.alias("number"), F.col("p.own").alias("anchor"), start.alias("start"), size.alias("size"))
    rows = rows.where((F.col("start") >= 1) & (F.col("start") + F.col("size") - 1 <= F.col("n")))
    text = F.substring("codes", 4 * F.col("start") - 3, 4 * F.col("size"))
    return rows.select("h", F.xxhash64("length", "number", text).alias("key"), "anchor")


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether the edit distance of two texts is at most ``edits``; both have more than ``edits`` characters."""
    m, n = F.length(a), F.length(b)
    top, mask = 2 * edits, (1 << (2 * edits + 1)) - 1
    one = F.lit(1).cast("long")

    def column(state: Column, j: Column, x: Column, y: Column) -> Column:
        up, down, distance = state["up"], state["down"], state["distance"]
        char = F.get(y, j)
        # Bit t of the column is the pattern's character at j - edits + t.
        bits = [F.when(F.get(x, F.greatest(j - edits + t, F.lit(-1))) == char, F.lit(1 << t).cast("long")).otherwise(F.lit(0).cast("long")) for t in range(top + 1)]
        match = bits[0]
        for bit in bits[1:]:
            match = match.bitwiseOR(bit)

        def with_match(p: Column) -> Column:
            zero = (p.bitwiseAND(up) + up).bitwiseXOR(up).bitwiseOR(p).bitwiseOR(down).bitwiseAND(F.lit(mask).cast("long"))
            return _let(zero, with_zero)

        def with_zero(zero: Column) -> Column:
            right = down.bitwiseOR(F.bitwise_not(zero.bitwiseOR(up))).bitwiseAND(F.lit(mask).cast("long"))
            return _let(F.struct(zero.alias("zero"), right.alias("right"), zero.bitwiseAND(up).alias("left"), F.shiftright(zero, 1).alias("moved")), with_deltas)

        def with_deltas(d: Column) -> Column:
            along = F.when(F.shiftright(d["zero"], top).bitwiseAND(one) == 1, 0).otherwise(1)
            seat = F.greatest(top - 1 - (j - (m - edits)), F.lit(0)).cast("int")
            across = (d["right"].bitwiseAND(F.call_function("shiftleft", one, seat)) != 0).cast("int") - (d["left"].bitwiseAND(F.call_function("shiftleft", one, seat)) != 0).cast("int")
            return F.struct(
                d["left"].bitwiseOR(F.bitwise_not(d["moved"].bitwiseOR(d["right"]))).bitwiseAND(F.lit(mask).cast("long")).alias("up"),
                d["moved"].bitwiseAND(d["right"]).alias("down"),
                (distance + F.when(j < m - edits, along).otherwise(across)).cast("int").alias("distance"),
            )

        return _let(match, with_match)

    start = F.struct(F.lit(((1 << (edits + 1)) - 1) << edits).cast("long").alias("up"), F.lit(0).cast("long").alias("down"), F.lit(edits).cast("int").alias("distance"))
    chars = F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y"))
    found = _let(chars, lambda c: F.aggregate(F.sequence(F.lit(0), n - 1), start, lambda s, j: column(s, j, c["x"], c["y"])))
    return (F.abs(m - n) <= edits) & (found["distance"] <= edits)


class _Links:
    """Confirms candidate pairs of line hashes on the lines themselves."""

    def __init__(self, scratch: Scratch, lines: DataFrame, edits: int):
        self.scratch, self.lines, self.edits, self.turn = scratch, lines, edits, 0

    def __call__(self, pairs: DataFrame, rows: int) -> DataFrame:
        self.turn += 1
        ids = self.scratch.keep(fewer_tasks(ends(pairs).select("id").distinct(), 2 * rows), f"ids-{self.turn}")
        texts = self.lines.join(few(ids, ids.count()), F.col("h") == F.col("id"), "left_semi")
        texts = self.scratch.keep(texts.groupBy("h").agg(F.first("line").alias("line")), f"texts-{self.turn}")
        met = texts.join(few(ends(pairs), 2 * rows), F.col("h") == F.col("id"))
        both = met.groupBy("a", "b").agg(*(F.max(F.when(F.col("side") == k, F.col("line"))).alias(name) for k, name in enumerate(("x", "y"))))
        links = both.where(within_edits(F.col("x"), F.col("y"), self.edits)).select("a", "b")
        links = self.scratch.keep(links, f"links-{self.turn}")
        self.scratch.drop(f"ids-{self.turn}", f"texts-{self.turn}")
        return links


def duplicate_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, line_no, class_doc_id, class_line_no, kept) of every nonblank line; kept is its class's first line."""
    if min_chars <= edits * (edits + 1):
        raise ValueError("min_chars must leave segments longer than the edits")
    scratch = Scratch(docs.sparkSession)
    lines = lines_of(docs, text, doc_id)
    hashed = lines.withColumn("h", F.xxhash64("line"))
    long_lines = hashed.where(F.length("line") >= min_chars)

    coded = long_lines.select("h", F.encode("line", "UTF-32").alias("codes"))
    coded = coded.select("h", "codes", F.expr("octet_length(codes) div 4").cast("int").alias("n"))
    keyed = keys(coded, edits)
    shared = keyed.groupBy(F.col("key").alias("of")).agg(F.min("h").alias("least"), F.max("h").alias("most")).where("least < most").select("of")
    shared = scratch.keep(shared, "shared")
    members = keyed.join(small(shared), F.col("key") == F.col("of"), "left_semi").groupBy("key", F.col("h").alias("id")).agg(F.max("anchor").alias("anchor"))
    members = scratch.keep(members, "filed")
    # Lines of shared keys are fetched once; every turn reads them from here.
    ids = members.select(F.col("id").alias("of")).distinct()
    met = long_lines.select("h", "line").join(small(scratch.keep(ids, "filed-ids")), F.col("h") == F.col("of"), "left_semi")
    met = scratch.keep(met.groupBy("h").agg(F.first("line").alias("line")), "met")
    met = scratch.keep(met.select("h", "line", histogram(F.col("line")).alias("mark")), "lines")
    n_members = members.count()
    members = scratch.keep(members.join(few(met.select("h", "mark"), n_members), F.col("id") == F.col("h")).drop("h"), "members")
    names, n_nodes = connect(members, n_members, _Links(scratch, met.select("h", "line"), edits), scratch, near=may_be_near(edits))

    # Places: one row per line, then the first place of each exact line and of each class.
    places = scratch.keep(hashed.select("doc_id", "line_no", "h", F.xxhash64(F.lit(1), "line").alias("g")), "places")
    named = places.join(few(names, n_nodes), F.col("h") == F.col("node"), "left")
    named = named.select("doc_id", "line_no", F.coalesce("component", "h").alias("c"), F.when(F.col("component").isNull(), F.col("g")).otherwise(F.lit(0)).alias("g"))
    named = scratch.keep(named, "named")
    first = named.groupBy(F.col("c").alias("fc"), F.col("g").alias("fg")).agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("size"))
    first, total = scratch.keep(first, "first"), named.count()
    # Classes of many lines are few, so they meet their lines without a shuffle; no other class holds a task.
    of_class = (F.col("c") == F.col("fc")) & (F.col("g") == F.col("fg"))
    hot, cold = (first.where(F.col("size") > total * HOT_SHARE), first.where(F.col("size") <= total * HOT_SHARE))
    out = named.join(F.broadcast(hot), of_class).unionByName(named.join(F.broadcast(hot), of_class, "left_anti").join(cold, of_class))
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no"))
    return out.select("doc_id", "line_no", F.col("first.doc_id").alias("class_doc_id"), F.col("first.line_no").alias("class_line_no"), kept.alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    """``op1_line_dedup``: class of every nonblank line of all documents."""
    return duplicate_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# The distance is taken on bytes there, so each accented letter is first put as one byte.
ORACLE = f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no
  FROM documents WHERE text IS NOT NULL
), lines AS MATERIALIZED (SELECT * FROM cut WHERE trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) <> ''
), uniq AS MATERIALIZED (
  SELECT line, row_number() OVER (ORDER BY line) AS id, length(line) AS n,
         translate(line, 'äöüßéèêçñóíáúàâîôûÄÖÜÉÈÊÇÑÓÍÁÚ', '0123456789~^*{{}}[]<>@#%$_+=;:?&') AS t
  FROM (SELECT DISTINCT line FROM lines)
), c AS MATERIALIZED (
  SELECT *, [length(t) - length(replace(t, x, '')) FOR x IN ['a', 'e', 'i', 'n', 't', 'r', 's', 'h', 'o', ' ', 'd', 'l']] AS k FROM uniq WHERE n >= {MIN_CHARS}
), links AS MATERIALIZED (
  SELECT a.id AS a, b.id AS b FROM c a JOIN c b ON b.n BETWEEN a.n AND a.n + {EDITS} AND a.id <> b.id
  WHERE abs(a.k[1] - b.k[1]) <= {EDITS} AND abs(a.k[2] - b.k[2]) <= {EDITS} AND abs(a.k[3] - b.k[3]) <= {EDITS} AND abs(a.k[4] - b.k[4]) <= {EDITS}
    AND abs(a.k[5] - b.k[5]) <= {EDITS} AND abs(a.k[6] - b.k[6]) <= {EDITS} AND abs(a.k[7] - b.k[7]) <= {EDITS} AND abs(a.k[8] - b.k[8]) <= {EDITS}
    AND levenshtein(a.t, b.t) <= {EDITS}
), both_ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (SELECT id AS node, id AS seen FROM uniq UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.seen = e.a
), comp AS (SELECT node, min(seen) AS c FROM reach GROUP BY node
), placed AS (SELECT l.doc_id, l.line_no, c.c FROM lines l JOIN uniq u USING (line) JOIN comp c ON c.node = u.id
), firsts AS (SELECT c, min(struct_pack(d := doc_id, l := line_no)) AS f FROM placed GROUP BY c)
SELECT p.doc_id, p.line_no, f.f.d AS class_doc_id, f.f.l AS class_line_no, p.doc_id = f.f.d AND p.line_no = f.f.l AS kept
FROM placed p JOIN firsts f USING (c)
"""
