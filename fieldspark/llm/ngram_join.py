"""N-gram Jaccard self-join with token-combination prefixes.

A text's set holds its distinct k-word shingles ("tokens" below). Two texts link when their sets' Jaccard likeness
reaches the threshold. All counts cover all texts, no text is cut and no posting list is capped.

1. Tokens are dealt by hash in binary blocks, and every token that stands in two or more different sets is found with
   its exact document frequency. Equal sets are one node from here on: their tokens are sent once per flush of a map
   task, and their documents never meet in one task. Tokens that many sets of a small sample share are hot: they count
   as the most frequent ones and go straight to their nodes, so that their holders don't meet either.
2. A node of n tokens can only link when at least ceil(t*n) of them are shared ones; all others leave. What two nodes
   have in common are shared tokens, so the shared tokens and n are all that verification needs.
3. Tokens are ordered by (frequency, hash). Rare tokens (class 1) are indexed alone, frequent ones (class k) by
   combinations of k from one token group. A prefix is extended until sum(max(c - k + 1, 0)) over its classes and
   groups exceeds the tokens a partner may lack; then two linked nodes share an indexed signature. Nodes too small for
   that index a plain prefix as well. Groups grow in number with the set size, so combinations stay linear in it; a node
   signs for its own size class and the next.
4. Round one verifies each node against one node of each of its signatures, the one with the largest share of shared
   tokens, and joins what links. Round two decides the candidates that are left: nodes that share a signature but not a
   component. What such signatures connect is a block. A block of bounded bytes is decided in one task. A larger one
   falls apart into its signatures (of those with the same nodes one is taken): a signature's nodes outside its largest
   component are compared with all its nodes, in pairs of tiles of bounded bytes. Overlaps are counted over the tokens'
   posting lists. No pair leaves a task unless it joins two components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .hashing import U, buffers, by_text, mix, shingles, slices, unique_sorted, words
from .store import hashed_sample, partitions, remove, shared_dir, stored
from .worker import tidy

FLUSH = 3 << 19  # tokens held by a map task before its blocks are sent on
FLUSH_DOCS = 1 << 17  # documents held, where copies add no tokens
TILE = 8 << 20  # bytes of token sets of a tile, or of a block that is decided at once
BASE, ASKED, BOTH = range(3)  # what a node is in a pair of tiles: one to compare with, one that is compared, either
TOP = 0xFFFFFFFF  # stands for the frequency of hot tokens
BLOCK = "part int, kind int, nodes binary, counts binary, tokens binary, extra binary"
_BLOCK = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("nodes", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary()), ("extra", pa.binary())])
_NODE = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("tokens", pa.binary()), ("dfs", pa.binary())])


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _BLOCK.types)], schema=_BLOCK)


def _hot_tokens(docs: DataFrame, k: int, sample: int, share: int, least: int) -> np.ndarray:
    """Sorted tokens of at least ``least`` and one in ``share`` of the sets of ``sample`` rows: at most ``share`` times a set's mean size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for whole in batches:
            for b in slices(whole, size=2 << 20):
                h, doc = words(*buffers(b.column("text")))[:2]
                for s in by_text(*shingles(h, doc, b.num_rows, k), b.num_rows):
                    s = unique_sorted(s)
                    key = xxhash.xxh3_128_digest(s.tobytes())
                    if len(s) and key not in seen:
                        seen.add(key)
                        yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], ["t"])

    few = hashed_sample(docs, sample, "doc_id").select("text").mapInArrow(run, "t long")
    got = few.groupBy("t").agg(F.count("*").alias("n")).where(F.col("n") >= max(2, least, sample // share)).select("t").collect()
    return np.sort(np.array([r["t"] for r in got], np.int64).view(np.uint64))


def _send_tokens(k: int, parts: int, hot: np.ndarray):
    """Texts -> blocks of tokens by hash (kind 0), of documents (kind 1, anywhere) and by node of sizes (kind 2) and hot tokens (kind 3).

    Of equal sets held at the same time one is sent, so copies add documents but no tokens.
    """

    def flush(ids, sizes, nodes, sets, number):
        out = [((TaskContext.get().partitionId() + number) % parts, 1, np.array(nodes, np.uint64).tobytes(), np.array(sizes, np.int64).tobytes(), np.array(ids, np.int64).tobytes(), None)]
        node, size = np.array(list(sets), np.uint64), np.array([len(s) for s in sets.values()], np.int64)
        dest = (node % U(parts)).astype(np.int64)
        order = np.argsort(dest, kind="stable")
        edge = np.searchsorted(dest[order], np.arange(parts + 1))
        out += [(p, 2, node[order][a:b].tobytes(), size[order][a:b].tobytes(), None, None) for p, (a, b) in enumerate(zip(edge[:-1], edge[1:])) if a < b]
        tok, of = (np.concatenate(list(sets.values())), np.repeat(np.arange(len(size), dtype=np.int32), size)) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int32))
        sets.clear()

        def deal(kind, part, tok, of):
            order = np.argsort(part.astype(np.uint16) if parts < 65536 else part, kind="stable")
            edge = np.searchsorted(part[order], np.arange(parts + 1))
            tok, of = tok[order], of[order]
            for p, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
                if a < b:
                    c = np.bincount(of[a:b], minlength=len(size))
                    has = np.flatnonzero(c)
                    out.append((p, kind, node[has].tobytes(), c[has].astype(np.uint32).tobytes(), tok[a:b].tobytes(), None))

        if len(hot):
            is_hot = hot[np.minimum(np.searchsorted(hot, tok), len(hot) - 1)] == tok
            deal(3, dest[of[is_hot]], tok[is_hot], of[is_hot])
            tok, of = tok[~is_hot], of[~is_hot]
        deal(0, (tok % U(parts)).astype(np.int32), tok, of)
        return _blocks(out)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, nodes, sets, held, number = [], [], [], {}, 0, 0
        for whole in batches:
            for b in slices(whole, size=2 << 20):
                data, off = buffers(b.column("text"))
                h, doc = words(data, off)[:2]
                g, d = shingles(h, doc, b.num_rows, k)
                del h, doc
                for s in by_text(g, d, b.num_rows):
                    s = unique_sorted(s)
                    sizes.append(len(s))
                    nodes.append(xxhash.xxh3_64_intdigest(s.tobytes()) >> 1)
                    if len(s) and nodes[-1] not in sets:
                        sets[nodes[-1]] = s
                        held += len(s)
                ids += [-(2**63) if i is None else i for i in b.column("doc_id").to_pylist()]
                if held > FLUSH or len(ids) > FLUSH_DOCS:
                    yield flush(ids, sizes, nodes, sets, number)
                    ids, sizes, nodes, sets, held, number = [], [], [], {}, 0, number + 1
        if ids:
            yield flush(ids, sizes, nodes, sets, number)

    return run


def _find_shared(parts: int):
    """Blocks of one token range -> the tokens that two or more nodes have, by node; other blocks pass."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, counts, tokens = [], [], []
        for b in batches:
            for r in b.to_pylist():
                if r["kind"]:
                    yield _blocks([tuple(r.values())])
                else:
                    nodes.append(np.frombuffer(r["nodes"], np.uint64))
                    counts.append(np.frombuffer(r["counts"], np.uint32))
                    tokens.append(np.frombuffer(r["tokens"], np.uint64))
        if not tokens:
            return
        tok, cnt = np.concatenate(tokens), np.concatenate(counts).astype(np.int64)
        del tokens
        uniq, first, inv = np.unique(np.concatenate(nodes), return_index=True, return_inverse=True)
        own = np.zeros(len(cnt), bool)
        own[first] = True  # an equal set's other copies say nothing new
        if not own.all():
            tok = tok[np.repeat(own, cnt)]
        of = np.repeat(inv[own].astype(np.int32), cnt[own])
        s = np.sort(tok)
        again = np.flatnonzero(s[1:] == s[:-1])
        dup = s[again[np.concatenate(([True], s[again[1:]] != s[again[:-1]]))]] if len(again) else s[:0]
        if not len(dup):
            return
        df = np.searchsorted(s, dup, side="right") - np.searchsorted(s, dup)
        del s
        maybe = np.zeros(1 << 22, bool)
        maybe[(dup >> U(42)).astype(np.int64)] = True
        keep = np.flatnonzero(maybe[(tok >> U(42)).astype(np.int64)])
        tok, of = tok[keep], of[keep]
        at = np.minimum(np.searchsorted(dup, tok), len(dup) - 1)
        hit = dup[at] == tok
        tok, of, freq = tok[hit], of[hit], np.minimum(df[at[hit]], TOP - 1).astype(np.uint32)
        dest = (uniq % U(parts)).astype(np.int64)
        rank = np.empty(len(uniq), np.int64)
        by = np.argsort(dest, kind="stable")
        rank[by] = np.arange(len(uniq))
        uniq, dest, of = uniq[by], dest[by], rank[of]
        order = np.argsort(of, kind="stable")
        tok, of, freq = tok[order], of[order], freq[order]
        have, cnt = np.unique(of, return_counts=True)
        end = np.concatenate(([0], np.cumsum(cnt)))
        edge = np.searchsorted(dest[have], np.arange(parts + 1))
        for p, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
            if a < b:
                yield _blocks([(p, 0, uniq[have[a:b]].tobytes(), cnt[a:b].astype(np.uint32).tobytes(), tok[end[a] : end[b]].tobytes(), freq[end[a] : end[b]].tobytes())])

    return run


def _gather_nodes(percent: int):
    """Blocks of one node range -> a row per node with enough shared tokens to link; a row per document passes by."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sizes, tn, tc, tt, tf, hot = [], [], [], [], [], [], []
        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == 1:
                    doc, n, node = (np.frombuffer(r[c], np.int64) for c in ("tokens", "counts", "nodes"))
                    yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(n), pa.array(node), pa.nulls(len(doc), pa.binary()), pa.nulls(len(doc), pa.binary())], schema=_NODE)
                elif r["kind"] == 2:
                    nodes.append(np.frombuffer(r["nodes"], np.int64))
                    sizes.append(np.frombuffer(r["counts"], np.int64))
                elif r["kind"] == 3:
                    hot.append([np.frombuffer(r[c], d) for c, d in (("nodes", np.int64), ("counts", np.uint32), ("tokens", np.uint64))])
                else:
                    tn.append(np.frombuffer(r["nodes"], np.int64))
                    tc.append(np.frombuffer(r["counts"], np.uint32))
                    tt.append(np.frombuffer(r["tokens"], np.uint64))
                    tf.append(np.frombuffer(r["extra"], np.uint32))
        if hot:
            n, c, tok = (np.concatenate(x) for x in zip(*hot))
            own = np.zeros(len(n), bool)
            own[np.unique(n, return_index=True)[1]] = True  # an equal set's other copies say nothing new
            tn.append(n[own])
            tc.append(c[own])
            tt.append(tok[np.repeat(own, c)])
            tf.append(np.full(len(tt[-1]), TOP, np.uint32))
        if not tn:
            return
        uniq, first = np.unique(np.concatenate(nodes), return_index=True)
        size = np.concatenate(sizes)[first]
        of = np.concatenate([np.repeat(np.searchsorted(uniq, a), c) for a, c in zip(tn, tc)])
        have = np.bincount(of, minlength=len(uniq))
        good = (100 * have >= percent * size) & (have > 0)
        keep = good[of]
        of, tok, freq = of[keep], np.concatenate(tt)[keep], np.concatenate(tf)[keep]
        order = np.lexsort((tok, of))
        of, tok, freq = of[order], tok[order], freq[order]
        which = np.flatnonzero(good)
        edge = np.searchsorted(of, np.concatenate((which, [len(uniq)])))
        for lo in range(0, len(which), 512):
            w = which[lo : lo + 512]
            cut = [(edge[lo + i], edge[lo + i + 1]) for i in range(len(w))]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(w), pa.int64()), pa.array(size[w]), pa.array(uniq[w]), pa.array([tok[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([freq[a:b].tobytes() for a, b in cut], pa.binary())], schema=_NODE
            )

    return run


def signatures(tok: np.ndarray, df: np.ndarray, n: int, percent: int, frequent: tuple[int, ...]) -> np.ndarray:
    """The index signatures of a node of n tokens with these shared tokens.

    frequent: document frequencies above which tokens belong to class 2, 3, ...; class k is indexed by k-combinations.
    The n - len(tok) tokens that no other node has come first in the order, so they only lengthen the prefix.
    Small nodes may use up their tokens before the prefix is long enough. Then the plain prefix of lack + 1 tokens is
    indexed alone too, for partners that used up theirs; one that did not shares a combination with the whole node. A
    node that is unlike even the same set with one more token links with nothing and needs none of this.
    """
    lack = n - -(-percent * n // 100)
    order = np.lexsort((tok, df))
    tok, kind = tok[order], 1 + np.searchsorted(np.array(frequent), df[order], side="left")
    alone = n - len(tok)
    size = max(0, n.bit_length() - 1)
    out = []
    for scheme in (size, size + 1):
        groups = max(1, (1 << scheme) // 16)
        group = (mix(tok + U(scheme)) % U(groups)).astype(np.int64)
        covered, members = alone, {}
        for i in range(len(tok)):
            if covered > lack:
                break
            k = int(kind[i])
            if k == 1:
                out.append(tok[i : i + 1])
                covered += 1
                continue
            held = members.setdefault((k, int(group[i])), [])
            held.append(i)
            covered += len(held) >= k
        for (k, g), held in members.items():
            if len(held) >= k:
                c = np.array(list(combinations(range(len(held)), k)))
                t = np.sort(tok[np.array(held)][c], axis=1)
                s = np.zeros(len(t), np.uint64)
                for j in range(k):
                    s = mix(s + t[:, j] * U(2 * j + 3))
                out.append(mix(s + U(scheme * 8 + k)))
        if covered <= lack and 100 * n >= percent * (n + 1):
            out.append(tok[: max(0, lack + 1 - alone)])
    return unique_sorted(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def _sign(percent: int, frequent: tuple[int, ...]):
    @tidy
    def run(batches):
        for b in batches:
            sig, node, n, s = [], [], [], []
            for row, size, tok, df in zip(b.column("node").to_pylist(), b.column("n").to_pylist(), b.column("tokens").to_pylist(), b.column("dfs").to_pylist()):
                t = np.frombuffer(tok, np.uint64)
                x = signatures(t, np.frombuffer(df, np.uint32), size, percent, frequent)
                sig.append(x.view(np.int64))
                node.append(np.full(len(x), row))
                n.append(np.full(len(x), size))
                s.append(np.full(len(x), len(t)))
            if sig:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (sig, node, n, s)], ["sig", "node", "n", "s"])

    return run


def _verify(percent: int):
    @tidy
    def run(batches):
        for b in batches:
            keep = []
            for na, ta, nb, tb in zip(*(b.column(c).to_pylist() for c in ("na", "ta", "nb", "tb"))):
                x, y = np.frombuffer(ta, np.uint64), np.frombuffer(tb, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (na + nb - both))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(keep)), b.column("b").filter(pa.array(keep))], ["a", "b"])

    return run


def _links(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "ta", "nb", "tb").mapInArrow(_verify(percent), "a long, b long")


def _merges(rows: list[dict], percent: int) -> list[tuple[int, int]]:
    """Roots of one tile pair that a link joins, as a forest: each pair of different roots is decided once."""
    sets = [np.frombuffer(r["tokens"], np.uint64) for r in rows]
    size, root = (np.array([r[c] for r in rows], np.int64) for c in ("n", "root"))
    role = np.array([r["role"] for r in rows])
    names, at = np.unique(root, return_inverse=True)
    base = np.flatnonzero(role != ASKED)
    most = np.bincount(at).argmax()  # where all are compared with all, one of two different roots is not the most frequent one
    if len(names) < 2 or not len(base):
        return []
    known, flat = np.unique(np.concatenate([sets[i] for i in base]), return_inverse=True)
    order = np.argsort(flat, kind="stable")
    holder = np.repeat(np.arange(len(base)), [len(sets[i]) for i in base])[order]
    first = np.searchsorted(flat[order], np.arange(len(known) + 1))
    up, size_of, root_of = np.arange(len(names)), size[base], at[base]
    out = []
    for x in np.flatnonzero((role == ASKED) | (role == BOTH) & (at != most)):
        t = np.minimum(np.searchsorted(known, sets[x]), len(known) - 1)
        t = t[known[t] == sets[x]]
        if not len(t):
            continue
        n = first[t + 1] - first[t]
        end = np.cumsum(n)
        both = np.bincount(holder[np.repeat(first[t] - (end - n), n) + np.arange(end[-1])], minlength=len(base))
        hit = np.flatnonzero((100 * both >= percent * (size[x] + size_of - both)) & (up[root_of] != up[at[x]]))
        for y in hit[np.unique(root_of[hit], return_index=True)[1]]:
            a, b = up[root_of[y]], up[at[x]]
            if a != b:
                up[up == max(a, b)] = min(a, b)
                out.append((int(root[x]), int(root[base[y]])))
    return out


def _compare(percent: int):
    """Rows in order of (sig, i, j) -> links between different roots, a tile pair at a time."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done():
            out = _merges(held, percent)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

        for b in batches:
            for r in b.to_pylist():
                now = (r["sig"], r["i"], r["j"])
                if now != key and held:
                    yield done()
                    held = []
                key = now
                held.append(r)
        if held:
            yield done()

    return run


def _candidates(sigs: DataFrame, first: DataFrame, nodes: DataFrame, folder: str, parts: int, tile: int) -> DataFrame:
    """Nodes that share a signature but not a root, in groups (sig, i, j) of one task each."""
    rooted = stored(sigs.join(first, "node", "left").select("sig", "node", "s", F.coalesce("root", "node").alias("root")), f"{folder}/rooted")
    mixed = rooted.groupBy("sig").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("node").alias("b")).where("r0 < r1").select("sig", "b")
    meet = stored(rooted.join(mixed, "sig"), f"{folder}/meet")
    block = components(meet.select(F.col("node").alias("a"), "b"), f"{folder}/blocks").withColumnRenamed("root", "block")
    one = stored(block.join(meet.groupBy("node").agg(F.max("s").alias("s"), F.max("root").alias("root")), "node"), f"{folder}/members")
    large = one.groupBy("block").agg(F.sum(8 * F.col("s")).alias("size")).withColumn("large", F.col("size") > tile).select("block", "large")
    one = one.join(large, "block")
    whole = one.where(~F.col("large")).select(F.col("block").alias("sig"), F.lit(-1).cast("long").alias("i"), F.lit(0).cast("long").alias("j"), F.lit(BOTH).alias("role"), "node", "root")

    rest = meet.join(one.where("large").select("node"), "node").select("sig", "node", "s", "root")
    of = rest.groupBy("sig", "root").agg(F.count("*").alias("m"), F.sum(8 * F.col("s")).alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    most = F.max(F.struct("m", "root", "size"))
    group = of.groupBy("sig").agg(most.getField("root").alias("major"), F.ceil((F.sum("size") - most.getField("size")) / tile).alias("asks"), F.ceil(F.sum("size") / tile).alias("tiles"), F.sum("m").alias("m"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    group = group.groupBy("x", "y", "m").agg(F.min(F.struct("sig", "major", "tiles", "asks")).alias("g")).select("g.*")
    held = rest.join(group, "sig")
    at = lambda n: F.pmod(F.xxhash64("node"), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    base = held.withColumns({"i": at("tiles"), "role": F.lit(BASE)}).withColumn("j", every("asks"))
    asked = held.where("root <> major").withColumns({"j": at("asks"), "role": F.lit(ASKED)}).withColumn("i", every("tiles"))
    ids = whole.union(base.select(*whole.columns)).union(asked.select(*whole.columns))
    return ids.join(nodes.select("node", "n", "tokens"), "node").repartition(parts, "sig", "i", "j").sortWithinPartitions("sig", "i", "j", "role", "node")


def ngram_components(docs: DataFrame, k: int = 5, percent: int = 75, frequent: tuple[int, ...] = (32, 1024), hot: tuple[int, int, int] = (4096, 16, 64), tile: int = TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id): the classes of the n-gram Jaccard join of ``docs`` (doc_id long, text).

    percent: two texts link when 100 * |A & B| >= percent * |A | B|. Texts that are null, empty or without words have
    n_shingles 0 and link with nothing, each its own component. A repeated row gives a repeated result row; rows with
    the same doc_id share that id as component_id unless a smaller id is reachable. A null doc_id stays null, takes
    part in links, and is never a component_id unless its whole component is null. Other columns are ignored. An empty
    table gives an empty table. Equal sets are told by 63-bit hashes and words and tokens by 64-bit hashes, so a false
    link needs a collision: some five are to be expected among 10**10 different sets. doc_id -2**63 counts as null.
    hot: (rows of the sample, share, least) of _hot_tokens; hot and tile move data and change no result. Memory of a task follows
    1/spark.sql.shuffle.partitions of the tokens: raise it with the input.
    """
    spark = docs.sparkSession
    folder, parts = shared_dir(spark, "ngram"), partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sent = docs.mapInArrow(_send_tokens(k, parts, _hot_tokens(docs, k, *hot)), BLOCK)
    shared = sent.repartitionById(parts, F.col("part")).mapInArrow(_find_shared(parts), BLOCK)
    rows = shared.repartitionById(parts, F.col("part")).mapInArrow(_gather_nodes(percent), "doc_id long, n long, node long, tokens binary, dfs binary")
    rows = stored(rows, f"{folder}/rows")
    nodes = rows.where("tokens is not null").select("node", "n", "tokens", "dfs")
    sigs = stored(nodes.mapInArrow(_sign(percent, frequent), "sig long, node long, n long, s long"), f"{folder}/sigs")

    likeliest = F.max(F.struct((F.col("s") * 1_000_000 / F.col("n")).cast("long").alias("q"), "node"))
    lists = sigs.groupBy("sig").agg(likeliest.getField("node").alias("b"), (F.min("node") < F.max("node")).alias("several")).where("several")
    pairs = sigs.select("sig", F.col("node").alias("a")).join(lists, "sig").where("a <> b").select("a", "b").distinct()
    first = components(_links(pairs, nodes, percent), f"{folder}/one")
    first = stored(first, f"{folder}/first")

    work = _candidates(sigs, first, nodes, folder, parts, tile)
    more = stored(work.mapInArrow(_compare(percent), "a long, b long"), f"{folder}/more")
    remove(spark, *(f"{folder}/{x}" for x in ("one", "sigs", "rooted", "meet", "blocks", "members")))

    merged = stored(components(more, f"{folder}/two").select(F.col("node").alias("root"), F.col("root").alias("last")), f"{folder}/second")
    singles = merged.join(first.select("node").distinct(), merged.root == F.col("node"), "left_anti").select(F.col("root").alias("node"), "last")
    final = first.join(merged, "root", "left").select("node", F.coalesce("last", "root").alias("last")).union(singles)

    out = rows.where("tokens is null").select(F.when(F.col("doc_id") != F.lit(-(2**63)), F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), "node")
    words_ = out.where("n_shingles > 0").join(final, "node", "left").withColumn("root", F.coalesce("last", "node"))
    low = stored(words_.groupBy("root").agg(F.min("doc_id").alias("component_id")), f"{folder}/low")
    remove(spark, f"{folder}/two", f"{folder}/more")
    linked = words_.join(low, "root").select("doc_id", "n_shingles", "component_id")
    return linked.union(out.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
