"""Removal of passages that an earlier document holds, byte-exact, by bucket-pointer refinement.

A byte goes if a window of ``length`` bytes around it also stands in a document with a smaller id. Windows that are equal
share their least q-gram (by hash), so that q-gram is the window's initial bucket and nothing outside the bucket matters:

1. Texts, equal ones once, are packed into parts of bounded size: a table in buckets by part, read by each later step
   without a shuffle of text.
2. Parts send the distinct bucket codes of their windows, some 5 bytes each, to code ranges; a range answers with one bit
   a code: whether another document has a window in that bucket.
3. Parts send the distinct stretches of consecutive windows that lie in one live bucket, with their least id. A range
   sorts the windows of its stretches by bucket-pointer refinement: 8-byte buckets are refined by the bucket of the
   position 8 further, these by that 16 further, and these by that 18 further, which makes 50 bytes (other lengths
   likewise). Positions alone in their bucket leave the sort; each level reuses the pointers of the level before.
   A range answers with one bit a window: whether it has a smaller id elsewhere.
4. Parts mark and cut.

A passage that every document holds reaches a range once per part, never once per document, and no pair is listed.

Texts are read whole, as UTF-8; null counts as empty. Rows with a null id neither remove nor lose bytes. Rows that share
an id don't remove each other's bytes. Extra columns are left aside.
An empty table gives no rows. Of equal passages the one in the smallest id stays.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.textcode import U64, VALUES, mixed, powers
from tallycart.session import staged


#: Windows that are marked at once.
MARKED = 1 << 19


@dataclass(frozen=True)
class Settings:
    length: int = 50
    gram: int = 16
    #: Bytes of text in a part, and behind a code range.
    part: int = 4 << 20
    range: int = 4 << 20
    #: Bytes of stretches sorted at once within a range.
    step: int = 1 << 21


def octets(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number."""
    out = np.zeros(len(data), dtype=U64)
    padded = np.concatenate((data, np.zeros(16, dtype=np.uint8)))
    for k in range(8):
        view = padded[k : k + 8 * ((len(data) - k + 7) // 8)]
        out[k::8] = view.view(U64)[: len(out[k::8])]
    return out


@dataclass
class Part:
    """Texts end to end, and their windows as stretches of consecutive windows in one bucket."""

    data: np.ndarray
    edges: np.ndarray
    ids: np.ndarray
    first: np.ndarray  # a stretch's first window
    windows: np.ndarray  # how many windows it has
    code: np.ndarray  # its bucket
    owner: np.ndarray  # its text

    @classmethod
    def of(cls, data: bytes, lengths: list[int], ids: list[int], s: Settings) -> Part:
        buffer = np.frombuffer(data, dtype=np.uint8)
        edges = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
        firsts, counts, codes, owners = [], [], [], []
        begin = 0
        while begin < len(lengths):  # some texts at a time
            end = begin + 1
            while end < len(lengths) and edges[end + 1] - edges[begin] <= 1 << 20:
                end += 1
            at = edges[begin]
            own = edges[begin : end + 1] - at
            low = bucket_codes(buffer[at : edges[end]], s)
            last = np.zeros(len(low), dtype=bool)  # positions where a text has no window any more
            for a, b in zip(own, own[1:], strict=False):
                last[max(a, b - s.length + 1) : b] = True
            start = ~last
            start[1:] &= (low[1:] != low[:-1]) | last[:-1]
            stop = ~last
            stop[:-1] &= (low[1:] != low[:-1]) | last[1:]
            a, b = np.flatnonzero(start), np.flatnonzero(stop)
            firsts.append(a + at)
            counts.append(b - a + 1)
            codes.append(mixed(low[a]))  # least hashes crowd at zero; mixed ones fill all code ranges alike
            owners.append(np.searchsorted(own, a, side="right") - 1 + begin)
            begin = end
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, dtype=t)
        return cls(buffer, edges, np.array(ids, dtype=np.int64), join(firsts, np.int64), join(counts, np.int64), join(codes, U64), join(owners, np.int64))


def bucket_codes(data: np.ndarray, s: Settings) -> np.ndarray:
    """For the window at each position, the least hash of its q-grams."""
    eight = octets(data)
    late = np.zeros(len(data), dtype=U64)
    late[: max(0, len(data) - s.gram + 8)] = eight[s.gram - 8 :]
    low = mixed(eight * U64(0x9E3779B97F4A7C15) + mixed(late + U64(0x632BE59BD9B4E019)))
    width, done = s.length - s.gram + 1, 1
    while done < width:
        step = min(done, width - done)
        low[:-step] = np.minimum(low[:-step], low[step:])
        done += step
    return low


def stretch_codes(part: Part, chosen: np.ndarray, s: Settings) -> np.ndarray:
    """A code of the bytes of each chosen stretch."""
    out = np.zeros(len(chosen), dtype=U64)
    a, b = part.first[chosen], part.first[chosen] + part.windows[chosen] + s.length - 1
    step = 1 << 20
    place = 0
    while place < len(chosen):  # stretches stand in text order: some at a time
        base = a[place]
        stop = max(place + 1, int(np.searchsorted(b, base + step)))
        piece = part.data[base : b[stop - 1]]
        up, down = powers(len(piece))
        total = np.zeros(len(piece) + 1, dtype=U64)
        np.cumsum(VALUES[piece] * up[: len(piece)], out=total[1:])
        x, y = a[place:stop] - base, b[place:stop] - base
        out[place:stop] = mixed((total[y] - total[x]) * down[x] + (y - x).astype(U64) * U64(0xD6E8FEB86659FD93))
        place = stop
    return out


def ranges_of(codes: np.ndarray, bits: int) -> np.ndarray:
    return (codes >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(codes), dtype=np.int64)


def slices(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cuts = np.flatnonzero(np.diff(sorted_keys)) + 1 if len(sorted_keys) else []
    edges = [0, *list(cuts), len(sorted_keys)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield int(sorted_keys[a]), int(a), int(b)


@dataclass
class Buckets:
    """A part's distinct bucket codes in order, and whether two of its own texts share one."""

    codes: np.ndarray
    which: np.ndarray
    shared: np.ndarray

    @classmethod
    def of(cls, part: Part) -> Buckets:
        codes, which = np.unique(part.code, return_inverse=True)
        ids = part.ids[part.owner]
        least, most = np.full(len(codes), np.iinfo(np.int64).max), np.full(len(codes), np.iinfo(np.int64).min)
        np.minimum.at(least, which, ids)
        np.maximum.at(most, which, ids)
        return cls(codes, which, least < most)


def short(codes: np.ndarray, bits: int) -> np.ndarray:
    """Five bytes of each code behind the bits of its range."""
    return np.ascontiguousarray(((codes << U64(bits)) >> U64(24)).view(np.uint8).reshape(-1, 8)[:, :5])


def asked_codes(part: Part, bits: int) -> Iterator[tuple[int, bytes]]:
    b = Buckets.of(part)
    for r, i, j in slices(ranges_of(b.codes, bits)):
        yield r, _framed(short(b.codes[i:j], bits).tobytes(), np.packbits(b.shared[i:j]).tobytes())


def _framed(*blobs: bytes) -> bytes:
    head = np.array([len(blobs), *map(len, blobs)], dtype=np.int64).tobytes()
    return head + b"".join(blobs)


def _parts_of(frame: bytes) -> list[bytes]:
    n = int(np.frombuffer(frame[:8], dtype=np.int64)[0])
    sizes = np.frombuffer(frame[8 : 8 + 8 * n], dtype=np.int64).tolist()
    out, at = [], 8 + 8 * n
    for size in sizes:
        out.append(frame[at : at + size])
        at += size
    return out


def live_codes(asked: list[bytes]) -> list[bytes]:
    """For each request, a bit per code: another request has the code too, or its own texts share it."""
    found, flags, sizes = [], [], []
    for frame in asked:
        codes, shared = _parts_of(frame)
        wide = np.zeros((len(codes) // 5, 8), dtype=np.uint8)
        wide[:, :5] = np.frombuffer(codes, dtype=np.uint8).reshape(-1, 5)
        found.append(wide.reshape(-1).view(U64))
        flags.append(np.unpackbits(np.frombuffer(shared, dtype=np.uint8), count=len(wide)).astype(bool))
        sizes.append(len(wide))
    codes, live = np.concatenate(found), np.concatenate(flags)
    order = np.argsort(codes)
    same = np.flatnonzero(codes[order][1:] == codes[order][:-1])
    live[order[same]] = live[order[same + 1]] = True
    edges = np.concatenate(([0], np.cumsum(sizes)))
    return [np.packbits(live[a:b]).tobytes() for a, b in zip(edges, edges[1:], strict=False)]


@dataclass
class Stretches:
    """A part's distinct live stretches in the order of range and code; ``which`` leads from each live stretch to its
    own, ``chosen`` are the numbers of the live ones."""

    chosen: np.ndarray
    which: np.ndarray
    sample: np.ndarray
    least: np.ndarray
    range: np.ndarray

    @classmethod
    def of(cls, part: Part, answers: dict[int, bytes], bits: int, s: Settings) -> Stretches:
        b = Buckets.of(part)
        live = np.zeros(len(b.codes), dtype=bool)
        for r, i, j in slices(ranges_of(b.codes, bits)):
            live[i:j] = np.unpackbits(np.frombuffer(answers[r], dtype=np.uint8), count=j - i).astype(bool)
        chosen = np.flatnonzero(live[b.which])
        keys = np.zeros(len(chosen), dtype=[("code", U64), ("bytes", U64)])
        keys["code"], keys["bytes"] = part.code[chosen], stretch_codes(part, chosen, s)
        order = np.lexsort((keys["bytes"], keys["code"]))
        placed = keys[order]
        new = np.concatenate(([True], placed[1:] != placed[:-1])) if len(placed) else np.zeros(0, dtype=bool)
        which = np.empty(len(chosen), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        begins = np.flatnonzero(new)
        ids = part.ids[part.owner[chosen]][order]
        least = np.minimum.reduceat(ids, begins) if len(begins) else np.zeros(0, dtype=np.int64)
        sample = chosen[order[begins]]
        return cls(chosen, which, sample, least, ranges_of(part.code[sample], bits))


def asked_windows(part: Part, st: Stretches, bits: int, s: Settings) -> Iterator[tuple[int, bytes]]:
    data = memoryview(part.data)
    for r, i, j in slices(st.range):
        own = st.sample[i:j]
        text = b"".join(data[a : a + n + s.length - 1] for a, n in zip(part.first[own].tolist(), part.windows[own].tolist(), strict=True))
        fine = ((part.code[own] << U64(bits)) >> U64(48)).astype(np.uint16)
        frame = _framed(text, part.windows[own].astype(np.int32).tobytes(), st.least[i:j].tobytes(), fine.tobytes())
        yield r, zlib.compress(frame, 1)


def refined(data: np.ndarray, usable: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose ``length`` bytes also stand in another document, and the bucket of each. ``usable`` has how many
    bytes of its record follow each position."""
    at = np.flatnonzero(usable >= 8)
    depth = 8
    pointer = np.full(len(data), -1, dtype=np.int64)
    keys = octets(data)[at]
    while True:
        order = np.argsort(keys)
        placed = keys[order]
        new = np.concatenate(([True], placed[1:] != placed[:-1])) if len(placed) else np.zeros(0, dtype=bool)
        begins = np.flatnonzero(new)
        if not len(begins):
            return at[:0], at[:0]
        own = doc[at[order]]
        several = np.minimum.reduceat(own, begins) < np.maximum.reduceat(own, begins)
        bucket = np.cumsum(new) - 1
        kept = several[bucket]
        at, ids = at[order[kept]], bucket[kept]
        if depth >= length:
            return at, ids
        pointer[:] = -1
        pointer[at] = ids
        step = min(depth, length - depth)
        fits = usable[at] >= depth + step
        at, ids = at[fits], ids[fits]
        beyond = pointer[at + step]
        at, ids, beyond = at[beyond >= 0], ids[beyond >= 0], beyond[beyond >= 0]
        keys = ids * (len(begins) + 1) + beyond
        depth += step


def elsewhere(asked: list[bytes], s: Settings) -> list[bytes]:
    """For each request, a bit per window: an equal window stands in a document with a smaller id than its stretch's."""
    texts, windows, least, fine, owner = [], [], [], [], []
    for k, frame in enumerate(asked):
        text, n, ids, code = _parts_of(zlib.decompress(frame))
        texts.append(np.frombuffer(text, dtype=np.uint8))
        windows.append(np.frombuffer(n, dtype=np.int32).astype(np.int64))
        least.append(np.frombuffer(ids, dtype=np.int64))
        fine.append(np.frombuffer(code, dtype=np.uint16))
        owner.append(np.full(len(windows[-1]), k))
    data, n, ids, code = np.concatenate(texts), np.concatenate(windows), np.concatenate(least), np.concatenate(fine)
    size = n + s.length - 1
    begin = np.cumsum(size) - size
    bit_at = np.cumsum(n) - n
    bits = np.zeros(int(n.sum()), dtype=bool)
    order = np.argsort(code, kind="stable")
    cuts, held = [0], 0
    for k, (c, x) in enumerate(zip(code[order].tolist(), size[order].tolist(), strict=True)):
        if held > s.step and c != code[order[k - 1]]:  # records of one bucket stay together
            cuts.append(k)
            held = 0
        held += x
    cuts.append(len(order))
    for i, j in zip(cuts, cuts[1:], strict=False):
        own = np.sort(order[i:j])
        lengths = size[own]
        offset = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        piece = data[np.repeat(begin[own], lengths) + offset]
        usable = np.repeat(lengths, lengths) - offset
        doc = np.repeat(ids[own], lengths)
        at, bucket = refined(piece, usable, doc, s.length)
        if not len(at):
            continue
        starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        lowest = np.repeat(np.minimum.reduceat(doc[at], starts), np.diff(np.append(starts, len(at))))
        marked = at[lowest < doc[at]]
        record = np.searchsorted(np.cumsum(lengths), marked, side="right")
        bits[bit_at[own[record]] + offset[marked]] = True
    edges = np.concatenate(([0], np.cumsum([w.sum() for w in windows]))).astype(np.int64)
    return [np.packbits(bits[a:b]).tobytes() for a, b in zip(edges, edges[1:], strict=False)]


def cut(part: Part, st: Stretches, answers: dict[int, bytes], s: Settings) -> Iterator[tuple[int, int, str]]:
    """For each text: bytes removed, runs removed, and the digest of what stays."""
    step = np.zeros(len(part.data) + s.length + 1, dtype=np.int32)
    if len(st.chosen):
        n = part.windows[st.sample]
        at = np.zeros(len(n), dtype=np.int64)
        bits = []
        done = 0
        for r, i, j in slices(st.range):
            own = np.unpackbits(np.frombuffer(answers[r], dtype=np.uint8), count=int(n[i:j].sum()))
            at[i:j] = np.cumsum(n[i:j]) - n[i:j] + done
            done += len(own)
            bits.append(own)
        bits = np.concatenate(bits).astype(bool)
        first, count = part.first[st.chosen], part.windows[st.chosen]
        later = part.ids[part.owner[st.chosen]] > st.least[st.which]  # an earlier text of this part has the whole stretch
        held = np.cumsum(count)
        i = 0
        while i < len(count):  # some windows at a time
            j = max(i + 1, int(np.searchsorted(held, held[i] + MARKED)))
            own = count[i:j]
            offset = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            hit = np.repeat(later[i:j], own) | bits[np.repeat(at[st.which[i:j]], own) + offset]
            window = (np.repeat(first[i:j], own) + offset)[hit]
            np.add.at(step, window, 1)
            np.subtract.at(step, window + s.length, 1)
            i = j
    gone = np.cumsum(step[: len(part.data)], dtype=np.int32) > 0
    for a, b in zip(part.edges, part.edges[1:], strict=False):
        own = gone[a:b]
        runs = int(own[0]) + int((own[1:] & ~own[:-1]).sum())
        yield int(own.sum()), runs, hashlib.sha256(part.data[a:b][~own].tobytes()).hexdigest()


def packed_parts(texts: DataFrame, s: Settings) -> DataFrame:
    """Texts (doc_id, code, text) as rows of whole parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        held: tuple[list, list, list] = ([], [], [])
        size = 0

        def row() -> pa.RecordBatch:
            data = b"".join(held[2])
            lengths = [len(x) for x in held[2]]
            columns = [[base + number], [held[0]], [held[1]], [lengths], [data]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["pid", "ids", "codes", "lengths", "data"])

        for batch in batches:
            for k, code, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "code", "text")), strict=True):
                text = text.encode("utf-8", "surrogatepass")
                if size and size + len(text) > s.part:
                    yield row()
                    number += 1
                    held, size = ([], [], []), 0
                held[0].append(k)
                held[1].append(code)
                held[2].append(text)
                size += len(text)
        if size:
            yield row()

    return texts.select("doc_id", "code", "text").mapInArrow(run, "pid long, ids array<long>, codes array<string>, lengths array<long>, data binary")


def requests(parts: DataFrame, columns: list[str], make) -> DataFrame:
    """(r, pid, frame) rows that ``make`` derives from each part and the given columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                made = list(make(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m[0] for m in made], pa.int64()), pa.array([row["pid"]] * len(made), pa.int64()), pa.array([m[1] for m in made], pa.binary())],
                    ["r", "pid", "frame"],
                )

    return parts.select("pid", "ids", "lengths", "data", *columns).mapInArrow(run, "r long, pid long, frame binary")


def answered(asked: DataFrame, reply, name: str) -> DataFrame:
    """Each range's replies to its requests, gathered by part: pid and its (r, frame) pairs, written as a table."""

    def run(table: pa.Table) -> pa.Table:
        frames = reply(table.column("frame").to_pylist())
        return pa.table({"r": table.column("r"), "pid": table.column("pid"), "frame": pa.array(frames, pa.binary())})

    replies = asked.groupBy("r").applyInArrow(run, "r long, pid long, frame binary")
    return staged(replies.groupBy("pid").agg(F.collect_list(F.struct("r", "frame")).alias(name)), name)


def removed_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """Per row: id, size in bytes, bytes and runs removed, and the digest of the bytes that stay."""
    s = settings or Settings()
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("code", F.sha2("text", 256))
    long_enough = rows.where((F.octet_length("text") >= s.length) & F.col("doc_id").isNotNull())
    distinct = long_enough.groupBy("code").agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"))
    table = f"passage_parts_{uuid.uuid4().hex}"
    total = long_enough.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packed_parts(distinct, s).write.bucketBy(max(1, min(total // s.part, 100_000)), "pid").saveAsTable(table)
    parts = spark.table(table)
    bits = max(0, int(np.ceil(np.log2(max(1, total / s.range)))))

    def part_of(row: dict) -> Part:
        return Part.of(row["data"], row["lengths"], row["ids"], s)

    def given(row: dict, name: str) -> dict[int, bytes]:
        return {x["r"]: x["frame"] for x in row[name] or []}

    def ask_windows(row: dict) -> Iterator[tuple[int, bytes]]:
        part = part_of(row)
        return asked_windows(part, Stretches.of(part, given(row, "live"), bits, s), bits, s)

    live = answered(requests(parts, [], lambda row: asked_codes(part_of(row), bits)), live_codes, "live")
    known = parts.join(live, "pid", "left")
    marks = answered(requests(known, ["live"], ask_windows), lambda frames: elsewhere(frames, s), "marks")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                part = part_of(row)
                found = list(cut(part, Stretches.of(part, given(row, "live"), bits, s), given(row, "marks"), s))
                columns = [pa.array(row["codes"], pa.string()), pa.array(row["ids"], pa.int64())]
                columns += [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["code", "first", "removed", "runs", "kept"])

    whole = known.join(marks, "pid", "left").select("pid", "ids", "codes", "lengths", "data", "live", "marks")
    found = staged(whole.mapInArrow(finish, "code string, first long, removed long, runs long, kept string"), "cut-texts")
    spark.sql(f"DROP TABLE {table}")
    out = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "code").join(found, "code", "left")
    first = F.col("doc_id") == F.col("first")
    touched = F.col("first").isNotNull() & F.col("doc_id").isNotNull()
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "doc_id", "n_bytes",
        F.when(~touched, F.lit(0)).when(first, F.col("removed")).otherwise(F.col("n_bytes")).cast("long").alias("n_removed"),
        F.when(~touched, F.lit(0)).when(first, F.col("runs")).otherwise(F.lit(1)).cast("long").alias("n_spans"),
        F.when(~touched, F.col("code")).when(first, F.col("kept")).otherwise(F.lit(nothing)).alias("kept_sha256"),
    )
