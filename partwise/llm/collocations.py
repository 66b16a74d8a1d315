"""Phrase collocations on a weighted de Bruijn graph of words.

Texts are cut into pieces and words. A node is two neighbouring words of a piece,
an edge three: from its first two to its last two. Only these longest grams are
aggregated, together with the ends of the pieces; every shorter count follows:

* f(a b) is what flows out of the node, the edges (a b x), and the pieces that end in a b;
* f(a) is what flows out of all nodes (a x), and the pieces that end in a.

Edges are summed in numpy where the texts are read, a few million at a time, and
then by Spark's exchange, dealt by node, so that a task sees all edges of a node
and its flow at once. Nodes that hold more than HOT_SHARE of the edges are found
on a sample before; their edges are dealt by the third word too, their flow is put
together afterwards. (The sample decides about dealing alone.) What comes out is
small: edges and nodes of at least ``least`` occurrences, and words.

Unary paths: a node all of whose occurrences come in by one edge and go out by one
edge is inside a path, whose edges have one weight. Paths are put together by
pointer jumping. Inside a path the counts of two words are the weight, and the node
is no candidate of its own: the edge that holds it is as frequent. Only the nodes
at the ends of paths are looked up for their flow.

Words are 64-bit hashes of lang and word until the end, when a second reading of
the texts brings the words of the candidates back. Two words of one hash would show
there; then all is done again with other hashes, so counts are exact.

Cases: NULL text is empty, NULL lang is ``und`` (one with the lang of that name).
Empty pieces have no words. Rows count one by one, whatever their doc_id. Empty
table: no rows. Other columns are ignored. A text is held whole in its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm.common import LOWER, as_long, column, flat, key_filter, mix, passes, slices, span_hashes, spans, stored, utf8
from partwise.operators.joins import broadcast_if_small

#: Bytes that end a piece (. , ; : ! ? and \\n to \\r), and bytes of words (all others but space and tab).
PIECE_END = np.array([c in b".,;:!?" or 0x0A <= c <= 0x0D for c in range(256)])
WORD = np.array([not (c in b" \t.,;:!?" or 0x0A <= c <= 0x0D) for c in range(256)])
#: Edges that a task sums before it hands them on.
CHUNK = 1 << 20
#: Share of a task's sampled edges from which a node's edges are spread over tasks.
HOT_SHARE = 1 / 2000
SPREAD = 64
SAMPLE = 0.02
#: Words of more bytes are hashed one by one; a polynomial can be led to collisions by very long words.
LONG_WORD = 256
_OTHER = np.random.default_rng(7).permutation(256).astype(np.uint8)
_LANG, _END = "lang_hash", 0


def _words(batch: pa.RecordBatch, attempt: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of a batch: lowered bytes, start, end, row, id, a second hash, and whether the word is the last of its piece."""
    raw, offsets = flat(column(batch, "text"))
    data = LOWER[raw]
    start, end, row = spans(WORD[data], offsets)
    word, second = span_hashes(data, start, end), span_hashes(_OTHER[data], start, end)
    for i in np.flatnonzero(end - start > LONG_WORD).tolist():
        body = data[start[i] : end[i]].tobytes()
        word[i], second[i] = xxhash.xxh3_64_intdigest(body, 1), xxhash.xxh3_64_intdigest(body, 2)
    if attempt:
        word = mix(word ^ mix(second + np.uint64(attempt)))
    langs = column(batch, _LANG).to_numpy(zero_copy_only=False).view(np.uint64)
    word = mix(word ^ langs[row]) >> np.uint64(max(0, 64 - bits - 16 * attempt)) | np.uint64(1)  # 0 marks the end of a piece
    ends = np.concatenate(([0], np.cumsum(PIECE_END[data])))
    last = np.ones(len(start), bool)
    last[:-1] = (row[1:] != row[:-1]) | (ends[start[1:]] != ends[start[:-1]])
    return data, start, end, row, word, second, last


def _grams(word: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Rows (w1, w2, w3): every edge, (w1, w2, 0) for two words that end a piece, (w1, 0, 0) for a word that does."""
    n = len(word)
    if n == 0:
        return np.zeros((0, 3), np.uint64)
    second = np.where(last, np.uint64(_END), np.append(word[1:], np.uint64(_END)))
    third = np.where(last, np.uint64(_END), np.append(second[1:], np.uint64(_END)))
    return np.stack([word, second, third], axis=1)


def _summed(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((grams[:, 2], grams[:, 1], grams[:, 0]))
    grams, n = grams[order], n[order]
    fresh = np.flatnonzero(np.concatenate(([True], (grams[1:] != grams[:-1]).any(axis=1))))
    return grams[fresh], np.add.reduceat(n, fresh)


def _read_edges(attempt: int, bits: int, hot):
    """Edges summed a CHUNK at a time; ``spread`` is the part of a hot node that an edge goes to."""

    def out(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        grams = np.concatenate(parts)
        grams, n = _summed(grams, np.ones(len(grams), np.int64))
        node = mix(grams[:, 0] ^ mix(grams[:, 1]))
        spread = np.where(np.isin(node, hot.value), (mix(grams[:, 2]) % np.uint64(SPREAD)).astype(np.int32), np.int32(0)) if len(hot.value) else np.zeros(len(n), np.int32)
        for at in range(0, len(n), 1 << 16):
            cut = slice(at, at + (1 << 16))
            cols = [pa.array(as_long(np.ascontiguousarray(grams[cut, k]))) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n[cut]), pa.array(spread[cut].astype(np.int32))], ["w1", "w2", "w3", "n", "spread"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for cut in slices(batch, "text", 1 << 20):
                *_, word, _, last = _words(cut, attempt, bits)
                parts.append(_grams(word, last))
                held += len(word)
                if held >= CHUNK:
                    yield from out(parts)
                    parts, held = [], 0
        if held:
            yield from out(parts)

    return read


def _read_hot(attempt: int, bits: int):
    """(node, share) of the nodes that hold over HOT_SHARE of a task's distinct edges."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def out():
            grams = np.concatenate(parts)
            grams, _ = _summed(grams, np.ones(len(grams), np.int64))
            node, n = np.unique(mix(grams[:, 0] ^ mix(grams[:, 1])), return_counts=True)
            many = n > max(64, HOT_SHARE * len(grams))
            return pa.RecordBatch.from_arrays([pa.array(as_long(node[many])), pa.array(n[many].astype(np.int64))], ["node", "n"])

        for batch in batches:
            for cut in slices(batch, "text", 1 << 20):
                *_, word, _, last = _words(cut, attempt, bits)
                parts.append(_grams(word, last))
                held += len(word)
                if held >= CHUNK:
                    yield out()
                    parts, held = [], 0
        if held:
            yield out()

    return read


_FOUND = ["w1", "w2", "w3", "n"]


def _flows(least: int, hot):
    """From edges sorted by (w1, w2, w3): edges of at least ``least``; (w1, w2, 0, flow) of nodes with as much and of hot ones,
    whose flow in other tasks comes on top; (w1, 0, 0, flow) of every word."""

    def rows(w1, w2, w3, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(as_long(np.ascontiguousarray(x))) for x in (w1, w2, w3)] + [pa.array(n)], _FOUND)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is still open: the last edge, and the earlier edges' sum of its node and of its word.
        edge, edge_n, node_n, word_n = None, 0, 0, 0
        none = np.zeros(0, np.uint64)

        def closed(grams: np.ndarray, n: np.ndarray, final: bool):
            nonlocal edge, edge_n, node_n, word_n
            if edge is not None:
                grams, n = np.concatenate((edge[None], grams)), np.concatenate(([edge_n], n))
            if not len(n):
                return
            change = grams[1:] != grams[:-1]
            starts = lambda differs: np.flatnonzero(np.concatenate(([True], differs)))
            e, v, w = starts(change.any(axis=1)), starts(change[:, :2].any(axis=1)), starts(change[:, 0])
            en, vn, wn = (np.add.reduceat(n, x) for x in (e, v, w))
            vn[0] += node_n
            wn[0] += word_n
            if not final:  # the last edge, node and word stay open
                edge, edge_n = grams[-1].copy(), int(en[-1])
                node_n, word_n = int(vn[-1]) - edge_n, int(wn[-1]) - edge_n
                e, v, w, en, vn, wn = (x[:-1] for x in (e, v, w, en, vn, wn))
            ge, gv, gw = grams[e], grams[v], grams[w]
            keep = (en >= least) & (ge[:, 2] != 0)
            many = vn >= least
            if len(hot.value):
                many |= np.isin(mix(gv[:, 0] ^ mix(gv[:, 1])), hot.value)
            many &= gv[:, 1] != 0
            zero = np.zeros(max(len(gv), len(gw)), np.uint64)
            yield rows(ge[keep, 0], ge[keep, 1], ge[keep, 2], en[keep])
            yield rows(gv[many, 0], gv[many, 1], zero[: int(many.sum())], vn[many])
            yield rows(gw[:, 0], zero[: len(gw)], zero[: len(gw)], wn)

        for batch in batches:
            grams = np.stack([column(batch, c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("w1", "w2", "w3")], axis=1)
            yield from closed(grams, column(batch, "n").to_numpy(zero_copy_only=False), False)
        yield from closed(np.zeros((0, 3), np.uint64), np.zeros(0, np.int64), True)

    return read


def graph(texts: DataFrame, least: int, attempt: int = 0, bits: int = 64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From (lang_hash, text): edges (w1, w2, w3, n), nodes (w1, w2, n) and words (w1, n) of at least ``least`` occurrences."""
    spark = texts.sparkSession
    sample = texts.sample(SAMPLE, seed=1).mapInArrow(_read_hot(attempt, bits), "node bigint, n bigint")
    # Every chunk names at most 1 / HOT_SHARE nodes; those that are hot in most of what was sampled are few.
    hottest = sample.groupBy("node").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "node").limit(int(1 / HOT_SHARE))
    hot = spark.sparkContext.broadcast(np.sort(hottest.toPandas()["node"].to_numpy(np.int64).view(np.uint64)))
    edges = texts.mapInArrow(_read_edges(attempt, bits, hot), "w1 bigint, w2 bigint, w3 bigint, n bigint, spread int")
    dealt = edges.repartition("w1", "w2", "spread").drop("spread").sortWithinPartitions("w1", "w2", "w3")
    found = stored(dealt.mapInArrow(_flows(least, hot), "w1 bigint, w2 bigint, w3 bigint, n bigint"), "phrase-flows")
    more = lambda rows, *by: rows.groupBy(*by).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    nodes = more(found.filter("w3 = 0 and w2 != 0"), "w1", "w2")
    words = more(found.filter("w3 = 0 and w2 = 0"), "w1")
    return found.filter("w3 != 0"), stored(nodes, "phrase-nodes"), stored(words, "phrase-words")


def compact(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Unary paths: (w1, w2, first1, first2, at) of the nodes inside one, ``at`` from 1 behind the path's first inner node; and
    ``edges`` with ``from_inner`` and ``to_inner``, whether the nodes at their ends are inside a path.

    A node is inside if one edge that leads to it and one that leaves it are as
    frequent as the node: then no piece begins or ends there, and no other edge does.
    A chain of such nodes has a first one, as every piece has a beginning.
    """
    out = edges.join(nodes.withColumnRenamed("n", "flow"), ["w1", "w2"]).filter("n = flow").select("w1", "w2")
    into = edges.select(F.col("w1").alias("w0"), F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n")
    into = into.join(nodes.withColumnRenamed("n", "flow"), ["w1", "w2"]).filter("n = flow").select("w0", "w1", "w2")
    inner = stored(into.join(out, ["w1", "w2"]), "phrase-inner")
    # Distance to, and the place of, a node further ahead: at first the one before, if it is inside too, else the node itself.
    key = inner.select("w1", "w2")
    before = inner.join(key.select(F.col("w1").alias("w0"), F.col("w2").alias("w1"), F.lit(True).alias("goes_on")), ["w0", "w1"], "left")
    goes_on = F.coalesce("goes_on", F.lit(False))
    chain = before.select(
        "w1", "w2", F.when(goes_on, F.col("w0")).otherwise(F.col("w1")).alias("p1"), F.when(goes_on, F.col("w1")).otherwise(F.col("w2")).alias("p2"),
        F.when(goes_on, 1).otherwise(0).cast("bigint").alias("at"),
    )
    chain = stored(chain, "phrase-chain")
    while True:
        ahead = chain.select(F.col("w1").alias("p1"), F.col("w2").alias("p2"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("at").alias("more"))
        new = stored(chain.join(ahead, ["p1", "p2"]).select("w1", "w2", F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("at") + F.col("more")).alias("at"), F.col("more")), "phrase-chain")
        chain = new.drop("more")
        if new.filter("more > 0").isEmpty():
            break
    paths = chain.select("w1", "w2", F.col("p1").alias("first1"), F.col("p2").alias("first2"), (F.col("at") + 1).alias("at"))
    marks = key.withColumn("inner", F.lit(True))
    marked = edges.join(marks.withColumnRenamed("inner", "from_inner"), ["w1", "w2"], "left")
    marked = marked.join(marks.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("inner").alias("to_inner")), ["w2", "w3"], "left")
    marked = marked.select("w1", "w2", "w3", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("from_inner", "to_inner")])
    return paths, stored(marked, "phrase-edges")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in exact integers; counts up to 10**15."""
    a, left, right = (x.cast("decimal(15,0)") for x in (a, left, right))
    top, below = (F.lit(1_000_000).cast("decimal(7,0)") * (a * a)).alias("top"), (left * right).alias("below")
    return F.struct(top, below)


def _lowest(rows: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """``rows`` with l, r and score of the lowest-scoring cut, the first of equal ones."""
    for k, (left, right) in enumerate(cuts):
        rows = rows.withColumn(f"s{k}", _score(F.col("n"), F.col(left), F.col(right)))
        rows = rows.withColumn(f"s{k}", F.expr(f"cast(s{k}.top div s{k}.below as bigint)"))
    found = [F.struct(F.col(f"s{k}").alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r")) for k, (left, right) in enumerate(cuts)]
    return rows.withColumn("best", F.least(*found) if len(found) > 1 else found[0]).select("w1", "w2", "w3", F.col("n").alias("a"), "best.l", "best.r", "best.score")


def candidates(edges: DataFrame, nodes: DataFrame, words: DataFrame, share: int = 50) -> DataFrame:
    """(w1, w2, w3, a, l, r, score): phrases of three words, and of two (w3 = 0) that no phrase of three holds with
    ``share`` % of their count or more."""
    paths, edges = compact(edges, nodes)
    inner = paths.select("w1", "w2")
    ends = stored(nodes.join(inner, ["w1", "w2"], "left_anti"), "phrase-ends")
    flow = lambda a, b, name: ends.select(F.col("w1").alias(a), F.col("w2").alias(b), F.col("n").alias(name))
    one = lambda a, name: words.select(F.col("w1").alias(a), F.col("n").alias(name))
    # Two words inside a path are as frequent as its edges; only nodes at ends of paths are looked up.
    three = edges.join(one("w1", "n1"), "w1").join(one("w3", "n3"), "w3").join(flow("w1", "w2", "n12"), ["w1", "w2"], "left").join(flow("w2", "w3", "n23"), ["w2", "w3"], "left")
    three = three.withColumns({"n12": F.when(F.col("from_inner"), F.col("n")).otherwise(F.col("n12")), "n23": F.when(F.col("to_inner"), F.col("n")).otherwise(F.col("n23"))})
    three = _lowest(three, [("n1", "n23"), ("n12", "n3")])
    around = edges.select("w1", "w2", "n").unionByName(edges.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n"))
    around = around.groupBy("w1", "w2").agg(F.max("n").alias("longer"))
    two = ends.join(around, ["w1", "w2"], "left").filter(F.coalesce(100 * F.col("longer") < share * F.col("n"), F.lit(True)))
    two = two.join(one("w1", "n1"), "w1").join(one("w2", "n2"), "w2").withColumn("w3", F.lit(0).cast("bigint"))
    return three.unionByName(_lowest(two, [("n1", "n2")]))


def _read_words(attempt: int, bits: int, wanted):
    """(lang, id, word) once a cut for words that pass the filter; (lang, NULL, NULL, number of words) of every cut."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, "text", 1 << 20):
                data, start, end, row, word, second, _ = _words(cut, attempt, bits)
                langs = np.array(column(cut, "lang").to_pylist(), object)
                hit = np.flatnonzero(passes(wanted.value, word))
                # Equal in both hashes: the same word.
                pairs = np.stack([word[hit], second[hit]], axis=1)
                order = np.lexsort((pairs[:, 1], pairs[:, 0]))
                pairs, hit = pairs[order], hit[order]
                if len(hit):
                    hit = hit[np.concatenate(([True], (pairs[1:] != pairs[:-1]).any(axis=1)))]
                found = [data[s:e].tobytes() for s, e in zip(start[hit].tolist(), end[hit].tolist())]
                names, code = np.unique(langs.astype(str), return_inverse=True) if len(langs) else (np.zeros(0, str), np.zeros(0, int))
                total = np.bincount(code[row], minlength=len(names)) if len(langs) else np.zeros(0, np.int64)
                lang = pa.array([*langs[row[hit]].tolist(), *[str(x) for x in names]], pa.string())
                ids = pa.array([*as_long(np.ascontiguousarray(word[hit])).tolist(), *[None] * len(names)], pa.int64())
                body = pa.array([*found, *[None] * len(names)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([lang, ids, body, pa.array([*[0] * len(hit), *total.tolist()], pa.int64())], ["lang", "id", "word", "n"])

    return read


def mine(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000, bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's ``top`` collocations of two and three words.

    a counts the phrase, l and r the two parts at the cut that scores lowest, n all
    words of the lang. Phrases of fewer than ``least`` occurrences, and those that a
    longer one holds with ``share`` % of their count, are no candidates. ``bits`` is
    the width of the word hashes at the first attempt (64 but in tests), 16 more at each other.
    """
    spark = docs.sparkSession
    lang = F.coalesce("lang", F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.xxhash64(lang).alias(_LANG), utf8().alias("text"))
    for attempt in range(8):
        found = stored(candidates(*graph(texts.select(_LANG, "text"), least, attempt, bits), share), "phrase-candidates")
        ids = stored(found.select(F.explode(F.array("w1", "w2", "w3")).alias("id")).filter("id != 0").distinct(), "phrase-ids")
        wanted = spark.sparkContext.broadcast(key_filter(ids, "id"))
        named = texts.mapInArrow(_read_words(attempt, bits, wanted), "lang string, id bigint, word string, n bigint")
        named = stored(named.groupBy("lang", "id", "word").agg(F.sum("n").alias("n")), "phrase-names")
        names = stored(named.filter("id is not null").join(ids, "id", "left_semi").select("id", "lang", "word"), "phrase-names")
        if names.groupBy("id").count().filter("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("words of equal hash in every attempt")
    word = lambda k: broadcast_if_small(names.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"word{k}")))
    rows = found.join(broadcast_if_small(names.select(F.col("id").alias("w1"), "lang", F.col("word").alias("word1"))), "w1").join(word(2), "w2").join(word(3), "w3", "left")
    rows = rows.withColumn("phrase", F.concat_ws(" ", "word1", "word2", "word3"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of a lang are among the best of each of its parts, so that no task sorts a whole lang.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    rows = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    total = named.filter("id is null").select("lang", "n")
    return rows.join(broadcast_if_small(total), "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = 10, share: int = 50, top: int = 2000) -> str:
    """The same by counting every phrase of one to three words in DuckDB."""
    return f"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
worded as (select lang, list_filter(regexp_split_to_array(piece, '[ \\t]'), lambda w: w <> '') as ws from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) as ws
  from worded, range(1, 4) t(k) where len(ws) >= k),
f as (select lang, k, ws, count(*) as n from grams group by all),
total as (select lang, sum(n)::bigint as n from f where k = 1 group by lang),
candidates as (select * from f where k > 1 and n >= {least}),
cuts as (
  select c.lang, c.k, c.ws, c.n as a, cut, l.n as l, r.n as r, (1000000::hugeint * c.n * c.n) // (l.n::hugeint * r.n) as score
  from candidates c, range(1, 3) t(cut)
  join f l on l.lang = c.lang and l.ws = c.ws[1:cut] join f r on r.lang = c.lang and r.ws = c.ws[cut + 1:]
  where cut < c.k),
best as (select * from cuts qualify row_number() over (partition by lang, ws order by score, cut) = 1),
inside as (
  select lang, ws[1:2] as ws, n from candidates where k = 3 union all select lang, ws[2:3], n from candidates where k = 3),
held as (select lang, ws, max(n) as longer from inside group by all),
named as (
  select b.lang, array_to_string(b.ws, ' ') as phrase, b.a, b.l, b.r, b.score
  from best b left join held h on h.lang = b.lang and h.ws = b.ws
  where h.longer is null or 100 * h.longer < {share} * b.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from named)
select r.lang, r.rank::bigint as rank, r.phrase, r.a::bigint as a, r.l::bigint as l, r.r::bigint as r, t.n, r.score::bigint as score
from ranked r join total t on t.lang = r.lang where r.rank <= {top}
"""
