"""Fuzzy line deduplication in DataFrame functions only.

Lines are normalised (lower case, runs of other characters than letters and digits become one space). Equal lines are one
node. A node's 64-bit SimHash is the majority, bit by bit, of its distinct words' hashes (a few common words would else decide
most bits). Words are rows while they are counted: each of 21 sums holds three counters of 20 bits and a spare one, a last sum
counts bit 63, so an aggregate of plain additions makes the 64 counts, exact to a million distinct words a line.

Hashes that differ in at most ``DISTANCE`` = 3 bits agree in three of six blocks (pigeonhole), so nodes meet under twenty block
triples of about 32 bits. Chance meetings grow with the square of the lines under any keys; at a hundred million lines and
evenly spread hashes they are a quarter a line under these, seven a line under pairs of five blocks (26 bits). Where just two
nodes meet, they are the pair. Where more meet, all are paired with one of them first; what is confirmed joins components, and
only then do nodes of different components under one key meet each other. So a group of near copies costs a few checks a line,
and no link between components is lost. Pairs within the distance are confirmed by edit similarity of the whole lines. Each
component keeps its first occurrence.
"""

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.llm.components import components
from starsift.llm.shared import stored

DISTANCE = 3
#: First bit and bits of the six blocks.
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
TRIPLES = list(combinations(range(6), 3))
SIMILARITY = 0.8
#: Bits of a counter, and the lowest bit of the three counters of a sum.
LANE = 21
LANES = 1 | 1 << LANE | 1 << 2 * LANE
#: Most characters of a common beginning that is cut off before edits are counted, halved down to 1.
CUTS = [1 << j for j in range(20, -1, -1)]


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), "[^\\p{L}\\p{N}]+", " "))


def _key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(id_col, text_col)


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key (of the row), id, pos, hash (of the normalised line), check (a second one), chars, sim of every line with a word."""
    every = F.transform(F.split(text_col, "\n"), normalised)  # a plain column would be evaluated again in the filter
    rows = docs.select(_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.posexplode(every).alias("pos", "line")).filter(F.col("line") != "")
    rows = rows.select("key", "id", "pos", F.xxhash64("line").alias("hash"), F.xxhash64(F.lit(7), "line").alias("check"), F.length("line").alias("chars"), F.explode(F.array_distinct(F.split("line", " "))).alias("word"))
    rows = rows.withColumn("h", F.xxhash64("word")).drop("word")
    lanes = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(LANES))).alias(f"s{j}") for j in range(LANE)]
    counted = rows.groupBy("key", "id", "pos", "hash", "check", "chars").agg(F.count("*").alias("n"), F.sum(F.shiftrightunsigned("h", 63)).alias("top"), *lanes)
    # added to a sum, this carries into the spare bit of each counter that is over half of n
    over = ((1 << LANE - 1) - 1 - F.shiftright("n", 1)) * F.lit(LANES)
    sim = F.when(2 * F.col("top") > F.col("n"), F.lit(-(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))
    for j in range(LANE):
        sim = sim.bitwiseOR(F.shiftleft(F.shiftrightunsigned(F.col(f"s{j}") + over, LANE - 1).bitwiseAND(F.lit(LANES)), j))
    return counted.select("key", "id", "pos", "hash", "check", "chars", sim.alias("sim"))


def _posted(nodes: DataFrame) -> DataFrame:
    """node under each of its twenty block triples."""
    block = [F.shiftrightunsigned("sim", at).bitwiseAND(F.lit((1 << bits) - 1)) for at, bits in BLOCKS]
    keys = [F.lit(t << 33).cast("long").bitwiseOR(F.shiftleft(block[i], 22)).bitwiseOR(F.shiftleft(block[j], 11)).bitwiseOR(block[k]) for t, (i, j, k) in enumerate(TRIPLES)]
    return nodes.select("node", F.explode(F.array(*keys)).alias("band"))


def _differing(x: Column, y: Column) -> Column:
    """An array of the two lines without what they begin with alike (as far as ``CUTS`` go), which leaves their edits as they are."""
    most = F.least(F.length(x), F.length(y))
    alike = lambda at, n: (at + n <= most) & (F.substring(x, at + 1, n) == F.substring(y, at + 1, n))
    same = F.aggregate(F.array(*map(F.lit, CUTS)), F.lit(0), lambda at, n: F.when(alike(at, n), at + n).otherwise(at))
    return F.transform(F.array(same), lambda n: F.struct(F.substring(x, n + 1, F.length(x)).alias("x"), F.substring(y, n + 1, F.length(y)).alias("y")))


def _close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose hashes and lengths let them be links."""
    a = nodes.select(F.col("node").alias("a"), F.col("sim").alias("sim_a"), F.col("chars").alias("chars_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("sim").alias("sim_b"), F.col("chars").alias("chars_b"))
    near = F.bit_count(F.col("sim_a").bitwiseXOR(F.col("sim_b"))) <= DISTANCE
    sized = F.least("chars_a", "chars_b") >= SIMILARITY * F.greatest("chars_a", "chars_b")
    return pairs.dropDuplicates().join(a, "a").join(b, "b").filter(near & sized).select("a", "b")


def _swapped(x: Column, y: Column) -> Column:
    """Characters of the words of ``x`` and ``y`` that differ from the word in the same place (the longer of the two)."""
    words = F.arrays_zip(F.split(x, " ").alias("p"), F.split(y, " ").alias("q"))
    return F.aggregate(words, F.lit(0), lambda n, w: n + F.when(w["p"] == w["q"], 0).otherwise(F.greatest(F.length(w["p"]), F.length(w["q"]))))


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Pairs whose whole normalised lines are at least ``SIMILARITY`` alike: 1 - edits / characters of the longer."""
    pairs = stored(pairs, "line-pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).dropDuplicates()
    places = nodes.join(wanted, "node", "left_semi").groupBy("one.key").agg(F.collect_list(F.struct("node", "one.pos")).alias("places"))
    held = docs.select(_key(id_col, text_col).alias("key"), text_col)
    found = held.join(places, "key").select(F.split(text_col, "\n").alias("lines"), "places").select("lines", F.explode("places").alias("p"))
    texts = stored(found.select("p.node", normalised(F.get("lines", F.col("p.pos"))).alias("line")).dropDuplicates(["node"]), "line-texts")
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("line").alias("x")), "a").join(texts.select(F.col("node").alias("b"), F.col("line").alias("y")), "b")
    most = F.expr(f"cast(floor((1 - {SIMILARITY}D) * greatest(length(x), length(y)) + 1e-9D) as int)")
    # rows of their own, or each use below would cut the lines again
    both = both.select("a", "b", most.alias("most"), F.explode(_differing(F.col("x"), F.col("y"))).alias("d"))
    both = both.select("a", "b", "most", F.explode(_differing(F.reverse("d.x"), F.reverse("d.y"))).alias("d")).select("a", "b", "most", "d.x", "d.y")
    # most pairs differ in a few words: replacing these where they stand is never fewer edits than the least
    swaps = F.when(F.size(F.split("x", " ")) == F.size(F.split("y", " ")), _swapped(F.col("x"), F.col("y")))
    # the work grows with the edits allowed, and most pairs need few
    within = " or ".join(f"levenshtein(x, y, most div {part}) >= 0" for part in (8, 1))
    return stored(both.filter(F.expr("greatest(length(x), length(y)) <= most") | (swaps <= F.col("most")) | F.expr(within)).select("a", "b"), "line-links")


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, removed (positions of lines to leave out) of the rows that lose lines."""
    lines = stored(occurrences(docs, id_col, text_col), "lines")
    place = F.struct(F.col("id").isNull().alias("nameless"), "id", "key", "pos")
    nodes = lines.groupBy("hash", "check").agg(F.count("*").alias("n"), F.first("sim").alias("sim"), F.first("chars").alias("chars"), F.min(place).alias("one"))
    # numbers pack closer than hashes where a node is posted often
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "line-nodes")
    bands = _posted(nodes).groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b")).filter((F.col("n") > 1) & (F.col("a") != F.col("b")))
    bands = stored(bands, "bands")
    crowded = stored(_posted(nodes).join(bands.filter("n > 2").select("band", "a"), "band"), "crowded")
    first = bands.filter("n = 2").select("a", "b").unionByName(crowded.filter(F.col("a") != F.col("node")).select("a", F.col("node").alias("b")))
    tried = stored(_close(first, nodes), "tried")
    links = _links(tried, nodes, docs, id_col, text_col)
    roots = components(links)

    placed = crowded.select("band", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("band")
    rest = stored(placed.join(open_, "band").join(nodes.select("node", "sim"), "node"), "open-lines")
    x = rest.select("band", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("sim").alias("sa"))
    y = rest.select("band", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("sim").alias("sb"))
    meet = (x["band"] == y["band"]) & (F.col("ra") != F.col("rb")) & (F.col("a") < F.col("b")) & (F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= DISTANCE)
    more = _close(x.join(y, meet).select("a", "b"), nodes).join(tried, ["a", "b"], "left_anti")
    more = stored(more, "more-lines")
    if not more.isEmpty():
        links = links.unionByName(_links(more, nodes, docs, id_col, text_col))
        roots = components(links)
    grouped = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first_of = grouped.groupBy("root").agg(F.min("one").alias("first"), F.sum("n").alias("n")).filter("n > 1")
    lose = stored(grouped.join(first_of.drop("n"), "root").select("hash", "check", F.col("first.key").alias("first_key"), F.col("first.pos").alias("first_pos")), "line-groups")
    gone = lines.join(lose, ["hash", "check"]).filter((F.col("key") != F.col("first_key")) | (F.col("pos") != F.col("first_pos")))
    return gone.groupBy("key").agg(F.collect_set("pos").alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with lines removed: every column as before, ``text_col`` without the lines, and n_lines, n_removed.

    The first occurrence of a group (smallest id, nulls last, then place in the text) stays. Lines without a letter or
    digit are never removed. A null text stays null with 0 lines; an empty text is one line. Rows with the same id and
    text count as one row, so what one keeps both keep. An empty table gives no rows. Columns named n_lines or
    n_removed are replaced.
    """
    gone = duplicate_lines(docs, id_col, text_col)
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row_")
    both = docs.select(row, F.col(text_col).alias("text_"), _key(id_col, text_col).alias("key_")).join(gone.withColumnRenamed("key", "key_"), "key_", "left")
    both = both.select("row_", F.split("text_", "\n").alias("lines_"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed_"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines_") - 1), "removed_")
    text = F.array_join(F.transform(stay, lambda i: F.get("lines_", i)), "\n")
    out = both.withColumns({"text_": text, "n_lines": F.when(F.col("lines_").isNull(), 0).otherwise(F.size("lines_")).cast("long"), "n_removed": F.size("removed_").cast("long")})
    kept = [F.col(f"row_.{c}") if c != text_col else F.when(F.col("lines_").isNotNull(), F.col("text_")).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return out.select(*kept, "n_lines", "n_removed")
