"""Near-duplicate documents by DartMinHash signatures and banded joining.

A document is the weighted set of its shingles of five words (lower-case ASCII, letters and digits; fewer words are
one shingle), weighted by how often they occur; similarity is the weighted Jaccard similarity, links need 0.8.

Signatures. Each shingle owns a half-open strip, as wide as its weight and without end in rank, onto which hashed
darts fall as a Poisson process of unit rate; the same darts for every document. A dart carries its rank and a
coordinate. Each coordinate keeps its earliest dart of all strips of a document; two documents agree in a coordinate
with a probability equal to their weighted Jaccard similarity. Only darts up to a rank of k (ln k + 2) / weight are
thrown, so a signature costs the number of shingles plus a constant, not k times it; documents with a coordinate
still empty go on to twice the rank.

Joining. Equal texts are one class first. Bands of `rows` coordinates meet by hash; with 24 bands of 5, a pair at
0.8 is missed with probability 7e-5. In a band's bucket all are compared with the bucket's leader (its least class)
by their whole lists of shingles, and links form components. A bucket of one component is done: groups of copies,
however large, end here. The texts of other buckets (a passage that many otherwise different texts share brings such
buckets) meet again by the rarest fifth of their shingles, of which two similar texts always share one. In each
of these smaller groups the members outside its largest component are compared with all other components: pair by
pair in groups of up to `few`, which share most of their pairs, and in larger ones in blocks of `block`, a block's
shingles as one table that every other member looks its own up in, with links between components coming out that
a task's other links do not imply, not pairs. No pair that can change a class is skipped for the size of its group.

Texts without words (null and empty ones too) are classes of their own, never linked. Rows that repeat an id and a
text are copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.llm.components import components
from inkveil.llm.rows import NO_ID, keyed, most_frequent, packed, unpacked
from inkveil.llm.textbytes import ALPHANUMERIC, BASE, LOWER, U64, Words, chunks, mix, shingles, signed, within
from inkveil.session import staged

SIGNED = "_id bigint, _th bigint, g binary, n bigint, bands array<bigint>"


@dataclass(frozen=True)
class NearParams:
    shingle_words: int = 5
    similarity: float = 0.8
    bands: int = 24
    rows: int = 5
    seed: int = 7
    #: Of the units of texts that share a bucket but no component, so many of the most frequent are told apart by count.
    common_units: int = 1 << 16
    #: Groups of so many members are compared pair by pair, larger ones in blocks.
    few: int = 16
    #: Members of a group that are held at once to compare others with.
    block: int = 256
    #: Members of a group that are compared with all others in one round, and members that one task takes of a group.
    leaders: int = 4096
    part: int = 2048

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


def elements(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each unit of weight: a shingle's n-th occurrence in a text is the unit (shingle, n)."""
    runs = shingles(words.hashes, width)
    inside = within(words.firsts, width, len(words.hashes))
    text, found = words.text[:len(runs)][inside], runs[inside]
    few = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(few):
        whole = np.zeros(len(few), U64)
        for k in range(width - 1):
            more = words.counts[few] > k
            whole[more] = whole[more] * U64(BASE) + words.hashes[words.firsts[few][more] + k]
        text, found = np.r_[text, few], np.r_[found, mix(whole + words.counts[few].astype(U64))]
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    fresh = np.r_[True, (found[1:] != found[:-1]) | (text[1:] != text[:-1])][:len(found)]
    opens = np.flatnonzero(fresh)
    layer = np.arange(len(found)) - np.repeat(opens, np.diff(np.r_[opens, len(found)]))
    return text, np.where(layer > 0, mix(found + layer.astype(U64) * U64(BASE)), found)


def signatures(text: np.ndarray, units: np.ndarray, n_texts: int, k: int, seed: int) -> np.ndarray:
    """The earliest dart of each coordinate: (n_texts, k), rank in the high half, the dart's hash in the low half."""
    empty = np.iinfo(np.uint64).max
    kept = np.full(n_texts * k, empty, U64)
    weight = np.bincount(text, minlength=n_texts)
    limit = np.where(weight > 0, k * (math.log(k) + 2) / np.maximum(weight, 1), 0)
    todo = np.arange(len(text))
    while len(todo):
        owner, state = text[todo], mix(units[todo] + U64(seed))
        rank = np.zeros(len(todo))
        most = limit[owner]
        while len(owner):
            state = mix(state + U64(BASE))
            rank = rank - np.log1p(-(state >> U64(11)).astype(np.float64) * 2.0**-53)
            near = rank <= most
            owner, state, rank, most = owner[near], state[near], rank[near], most[near]
            dart = mix(state ^ U64(0xD6E8FEB86659FD93))
            slot = owner * k + (dart % U64(k)).astype(np.int64)
            code = (rank.astype(np.float32).view(np.uint32).astype(U64) << U64(32)) | (dart >> U64(32))
            np.minimum.at(kept, slot, code)
        short = (kept.reshape(n_texts, k) == empty).any(axis=1) & (weight > 0)
        limit[short] *= 2
        todo = np.flatnonzero(short[text])
    return kept.reshape(n_texts, k)


def _sign(batches: Iterator[pa.RecordBatch], params: NearParams) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "_text"):
        words = Words(rows.column("_text"), ALPHANUMERIC, LOWER)
        n, k = rows.num_rows, params.coordinates
        text, units = elements(words, params.shingle_words)
        kept = signatures(text, units, n, k, params.seed).reshape(n, params.bands, params.rows)
        band = np.broadcast_to(np.arange(params.bands, dtype=U64), (n, params.bands)).copy()
        for r in range(params.rows):
            band = mix(band * U64(BASE) + kept[:, :, r])
        # The sequence of words, in 128 bits.
        place = np.arange(len(words.hashes)) - words.firsts[words.text]
        sums = [np.zeros(n + 1, U64) for _ in range(2)]
        for seed, total in enumerate(sums):
            each = mix(words.hashes + mix(place.astype(U64) + U64(seed * 977 + 1)))
            total[:] = np.r_[U64(0), np.cumsum(each)][np.r_[words.firsts]]
        same = np.stack([np.diff(total) for total in sums], axis=1).copy()
        yield pa.RecordBatch.from_arrays(
            [rows.column("_id"), rows.column("_th"), pa.array([x.tobytes() for x in same], pa.binary()),
             pa.array(words.counts), pa.ListArray.from_arrays(np.arange(0, n * params.bands + 1, params.bands, dtype=np.int32),
                                                            pa.array(signed(band).ravel()))],
            ["_id", "_th", "g", "n", "bands"])


def _list_units(batches: Iterator[pa.RecordBatch], params: NearParams) -> Iterator[pa.RecordBatch]:
    """The sorted 32-bit hashes of a text's units."""
    for rows in chunks(batches, "_text"):
        text, units = elements(Words(rows.column("_text"), ALPHANUMERIC, LOWER), params.shingle_words)
        short = (units >> U64(32)).astype(np.uint32)
        order = np.lexsort((short, text))
        cuts = np.searchsorted(text[order], np.arange(rows.num_rows + 1)).tolist()
        short = short[order]
        listed = [short[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([rows.column("g"), pa.array(listed, pa.binary())], ["g", "units"])


def _compare(batches: Iterator[pa.RecordBatch], params: NearParams) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        similar = []
        for a, b in zip(rows.column("units"), rows.column("leader_units"), strict=True):
            x, y = np.frombuffer(a.as_buffer(), np.uint32), np.frombuffer(b.as_buffer(), np.uint32)
            if min(len(x), len(y)) < params.similarity * max(len(x), len(y)):
                similar.append(False)
                continue
            both = np.sort(np.concatenate((x, y)), kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            similar.append(shared >= params.similarity * (len(x) + len(y) - shared))
        yield pa.RecordBatch.from_arrays(
            [rows.column("g"), rows.column("leader"), pa.array(similar, pa.bool_())], ["g", "leader", "similar"])


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        unit, n = np.unique(np.frombuffer(b"".join(rows.column("units").to_pylist()), np.uint32), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(unit.astype(np.int64)), pa.array(n)], ["unit", "n"])


def _rarest(batches: Iterator[pa.RecordBatch], params: NearParams, common: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each text so many of its rarest units that two similar texts share one of them."""
    for rows in batches:
        lists = []
        for raw in rows.column("units").to_pylist():
            units = np.frombuffer(raw, np.uint32)
            place = np.searchsorted(common["unit"], units)
            place[place == len(common)] = 0
            n = np.where(common["unit"][place] == units, common["n"][place], 0) if len(common) else np.zeros(len(units))
            order = np.lexsort((units, n))
            lists.append(np.unique(units[order[:int((1 - params.similarity) * len(units) + 1e-9) + 1]]).astype(np.int64))
        sizes = np.array([len(x) for x in lists])
        yield pa.RecordBatch.from_arrays(
            [rows.column("g").take(pa.array(np.repeat(np.arange(len(lists)), sizes))), pa.array(np.concatenate(lists))],
            ["g", "b"])


def _compared(pairs: DataFrame, units: DataFrame, params: NearParams) -> DataFrame:
    led = pairs.join(units, "g").join(
        units.select(F.col("g").alias("leader"), F.col("units").alias("leader_units")), "leader")
    return staged(led.select("g", "leader", "units", "leader_units").mapInArrow(
        partial(_compare, params=params), "g binary, leader binary, similar boolean"), "compared")


def _meet(batches: Iterator[pa.RecordBatch], params: NearParams) -> Iterator[pa.RecordBatch]:
    """Links between components: rows come by (b, block, part), the block's leaders before the others.

    A task tells only links between components that its own links do not join yet.
    """
    at, leaders, table = None, [], None
    joined: dict[bytes, bytes] = {}

    def root(c: bytes) -> bytes:
        while (up := joined.get(c, c)) != c:
            joined[c] = joined.get(up, up)
            c = up
        return c

    for rows in batches:
        found: list[tuple[bytes, bytes]] = []
        columns = [rows.column(c).to_pylist() for c in ("b", "block", "part", "leads", "g", "c", "units")]
        for b, block, part, leads, g, c, raw in zip(*columns, strict=True):
            if (b, block, part) != at:
                at, leaders, table = (b, block, part), [], None
            units = np.frombuffer(raw, np.uint32)
            if leads:
                leaders.append((g, c, units))
                continue
            if table is None:
                sizes = np.array([len(x) for _, _, x in leaders])
                known, place = np.unique(np.concatenate([x for _, _, x in leaders]), return_inverse=True)
                which = np.repeat(np.arange(len(leaders)), sizes)
                table = np.zeros((len(known), -(-len(leaders) // 8)), np.uint8)  # a bit for each leader
                np.bitwise_or.at(table, (place, which >> 3), (1 << (which & 7)).astype(np.uint8))
            near = np.searchsorted(known, units)
            near[near == len(known)] = 0
            bits = np.unpackbits(table[near[known[near] == units]], axis=1, count=len(leaders), bitorder="little")
            shared = bits.sum(axis=0, dtype=np.int64)
            for i in np.flatnonzero(shared >= params.similarity * (len(units) + sizes - shared)):
                leader, lc, _ = leaders[i]
                if (one := root(lc)) != (other := root(c)):
                    joined[one] = other
                    found.append((g, leader))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.binary())], ["u", "v"])


def _met(rows: DataFrame, units: DataFrame, params: NearParams) -> DataFrame:
    """Links of the members `leads` of each group with members of its other components."""
    messages = rows.select("b", "g", "c", F.lit(False).alias("leads"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                           F.pmod(F.xxhash64("g"), "parts").alias("part"))
    first = rows.where("leads").select("b", "g", "c", F.lit(True).alias("leads"), F.expr("pmod(xxhash64(g, 3L), blocks)").alias("block"),
                                       F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    # Random blocks may be empty: members without a leader have nobody to meet.
    full = first.select("b", "block").distinct()
    messages = messages.join(full, ["b", "block"], "left_semi").unionByName(first).join(units, "g")
    dealt = messages.repartition("b", "block", "part").sortWithinPartitions("b", "block", "part", F.desc("leads"))
    return staged(dealt.select("b", "block", "part", "leads", "g", "c", "units").mapInArrow(
        partial(_meet, params=params), "u binary, v binary").distinct(), "met")


def _tied(rows: DataFrame, tied: DataFrame) -> DataFrame:
    """The rows with their component c so far."""
    return rows.join(tied.withColumnRenamed("node", "g"), "g", "left").select("b", "g", F.coalesce("root", "g").alias("c"))


def tied(signed_: DataFrame, docs: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """(node, root) of the classes of equal texts that are similar to others, by component."""
    distinct = signed_.where("n > 0").dropDuplicates(["g"])
    buckets = distinct.select("g", F.explode("bands").alias("b"))
    leaders = buckets.groupBy("b").agg(F.min("g").alias("leader"), F.count("*").alias("m")).where("m > 1")
    leaders = staged(leaders.select("b", "leader"), "leaders")  # a table, so that the join of a large bucket can be split
    rows = staged(buckets.join(leaders, "b"), "bucket-rows")
    one_text = signed_.groupBy("g").agg(F.min(F.struct("_id", "_th")).alias("at"))
    one_text = one_text.join(rows.select("g").distinct(), "g").select("g", "at.*")
    texts = keyed(docs).join(one_text, ["_id", "_th"]).dropDuplicates(["g"]).select("g", "_text")
    units = staged(texts.mapInArrow(partial(_list_units, params=params), "g binary, units binary"), "units")
    compared = _compared(rows.where("g <> leader").select("g", "leader").distinct(), units, params)
    found = components(compared.where("similar").select(F.col("g").alias("u"), F.col("leader").alias("v")))

    placed = _tied(rows, found)
    open_ = placed.groupBy("b").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 <> c2").select("b")
    nodes = placed.join(open_, "b", "left_semi").select("g").distinct()
    loose = staged(units.join(nodes, "g"), "open-units")
    counted = loose.mapInArrow(_count_units, "unit bigint, n bigint").groupBy("unit").agg(F.sum("n").alias("n"))
    common = np.array(
        sorted((r.unit, r.n) for r in most_frequent(staged(counted.where("n > 8"), "unit-counts"), "n", params.common_units).collect()),
        dtype=[("unit", np.uint32), ("n", np.int64)])
    rows = loose.mapInArrow(partial(_rarest, params=params, common=common), "g binary, b bigint")
    # Groups of the same members are one group.
    members = rows.groupBy("b").agg(F.count("*").alias("m"), F.sum(F.xxhash64("g").cast("decimal(38,0)")).alias("s"))
    members = members.where("m > 1").groupBy("m", "s").agg(F.min("b").alias("b")).select("b")
    rows = staged(rows.join(staged(members, "groups"), "b", "left_semi").select("b", "g"), "rare")
    turn = 0
    while True:
        rows = _tied(rows, found)
        parts = rows.groupBy("b", "c").agg(F.count("*").alias("n"))
        groups = parts.groupBy("b").agg(F.max(F.struct("n", "c")).alias("most"), F.sum("n").alias("m")).where("most.n < m")
        outside = F.col("m") - F.col("most.n")
        groups = groups.select(
            "b", "m", F.col("most.c").alias("main"), F.ceil(outside / params.leaders).alias("turns"),
            F.ceil(F.least(outside, F.lit(2 * params.leaders)) / params.block).cast("int").alias("blocks"),
            F.ceil(F.col("m") / params.part).alias("parts"))
        rows = staged(rows.join(staged(groups, "mixed"), "b").withColumn(
            "leads", F.expr(f"c <> main and pmod(xxhash64(g, {turn}L), turns) = 0")), "mixed-rows")
        if rows.isEmpty():
            return found
        lead = rows.where(F.col("leads") & (F.col("m") <= params.few)).select("b", F.col("g").alias("leader"), F.col("c").alias("lc"))
        pairs = rows.join(lead, "b").where("c <> lc and (not leads or g > leader)").select("g", "leader").distinct()
        met = _met(rows.where(F.col("m") > params.few), units, params).unionAll(
            _compared(pairs, units, params).where("similar").select("g", "leader"))
        if not met.isEmpty():
            found = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(met))
        if rows.where("turns > 1").isEmpty():
            return found
        rows = rows.where("not leads").select("b", "g")
        turn += 1


def classes(docs: DataFrame, params: NearParams = NearParams()) -> tuple[DataFrame, DataFrame]:
    """(`_id`, `_th`, root_id, root_th) of each text, and the table of signatures; the root is the class's least key."""
    signed_ = staged(keyed(docs).mapInArrow(partial(_sign, params=params), SIGNED), "signatures")
    roots = tied(signed_, docs, params)
    rooted = signed_.where("n > 0").groupBy("g").agg(F.min(F.struct("_id", "_th")).alias("least"))
    rooted = rooted.join(roots, rooted.g == roots.node, "left").select("g", F.coalesce("root", "g").alias("root"), "least")
    rooted = staged(rooted, "rooted")
    least = staged(rooted.groupBy("root").agg(F.min("least").alias("least")), "least")
    of_text = rooted.select("g", "root").join(least, "root").select("g", "least")
    placed = signed_.select("_id", "_th", "g").join(of_text, "g", "left")
    own = F.coalesce("least", F.struct("_id", "_th"))
    return placed.select("_id", "_th", own["_id"].alias("root_id"), own["_th"].alias("root_th")), signed_


def class_ids(docs: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """One row per document: its class, named by the least doc_id in it, and whether it is the one that stands for it."""
    found, _ = classes(docs.select("doc_id", "text"), params)
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return found.select(back("_id").alias("doc_id"), back("root_id").alias("class_id"),
                        F.expr("_id = root_id and _th = root_th").alias("is_representative"))


def one_of_each(docs: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """The documents without near-duplicates: of each class the one of least id stays; all columns are kept.

    Texts without words all stay.
    """
    found, signed_ = classes(docs.select("doc_id", "text"), params)
    kept = found.where("_id = root_id and _th = root_th").select("_id", "_th").distinct()
    rows = packed(docs).join(kept, ["_id", "_th"], "left_semi")
    repeated = signed_.where("n > 0").groupBy("_id", "_th").count().where("count > 1").select("_id", "_th")
    if not repeated.isEmpty():  # rows that repeat id and text: one of them
        rows = rows.join(repeated.withColumn("again", F.lit(True)), ["_id", "_th"], "left")
        rows = rows.where("again is null").unionAll(rows.where("again").dropDuplicates(["_id", "_th"]))
    return unpacked(rows)
