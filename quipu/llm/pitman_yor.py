"""Language-model scores by a hierarchical Pitman-Yor model.

Every context, the word before or the start of the document, has a restaurant: its customers
are the words that follow it, its tables are customers of the parent, which all contexts share;
the parent's base is uniform over the known words and one unknown word.  Seating is sampled:
in each Gibbs sweep all customers of a word in a restaurant leave and are seated again, one
after another, by the Chinese-restaurant rule given everything else; beyond ``SINGLE``
customers they are seated in blocks of a quarter of those seated, with the chance of a new
table held for the block.  Samples after the burn-in are averaged as predictive probabilities.

How it scales.  All documents are counted.  A task turns its texts into numbers, with a
dictionary for each block of ``BLOCK`` tokens, and counts each block's pairs of words, so a
pair is shuffled once for each block and not once for each token.  Restaurants are dealt to
chunks by the hash of their context; the pairs of a context that is frequent in any block (a
``hot`` one) are dealt by both words, and its table count is summed by Spark once a sweep.
The parent is dealt by word.  In a sweep, a chunk sends its tables of each word to the parent,
which sums and seats them and sends its own counts back; a pair that occurs once has one table
for good, so only words of repeated pairs travel.  What no sweep changes is written once, and a
sweep writes its seats alone.  At the end each block gets the counts of the pairs and words that
it asked for.  All that travels is packed, a row for each two parts.

Defined results: null text is empty (its end is one token); rows of a null id are scored, never
learned from, and their held_out is null; repeated rows are learned from and scored again;
without training text every word is unknown.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import U64, byte_list, cut_rows, groups_of, mix64
from quipu.llm.span_dedup import word_hashes
from quipu.operators.corpus import fresh_path, pin_table

BLOCK, CHUNK = 1_250_000, 1_600_000   # tokens; a task's memory follows them
LEVEL = 9                       # of compression
HOT = 1000                      # least count in a block of a context whose pairs are dealt apart
SINGLE = 32
DISCOUNT, STRENGTH = 0.8, 1.0   # of the contexts
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 10.0
END = 0x2545F4914F6CDD1D        # stands for the end of a document
START = 0x6A09E667F3BCC909      # the context of its first word
STATE, MESSAGE, ASKED, CUSTOMERS, TABLES, ROOT, SEATS = range(7)
ASCENDING = {"u", "at", "ids"}   # arrays of places that mostly ascend
_ROW = "part long, kind int, src long, n long, data binary"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def squeeze(x: np.ndarray, steps: bool = False) -> bytes:
    """Numbers, or the steps between them, as bytes, plane by plane, compressed."""
    x = np.diff(x, prepend=x.dtype.type(0)) if steps else np.ascontiguousarray(x)
    return zstandard.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), LEVEL)


def unsqueeze(data: bytes, dtype: str, steps: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    x = np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()
    return np.cumsum(x, dtype=x.dtype) if steps else x


def in_steps(name: str, kind: str) -> bool:
    """Whether steps are the smaller form: for places in order, and for hashes, which are in
    order among words that are equally frequent."""
    return name in ASCENDING or kind == "<u8"


def pack(**arrays: np.ndarray) -> bytes:
    body = {k: (x.dtype.str, squeeze(x, in_steps(k, x.dtype.str))) for k, x in arrays.items()}
    head = json.dumps([[k, kind, len(z)] for k, (kind, z) in body.items()]).encode()
    return len(head).to_bytes(4, "little") + head + b"".join(z for _, z in body.values())


def unpack(data: bytes) -> dict[str, np.ndarray]:
    at = 4 + int.from_bytes(data[:4], "little")
    out = {}
    for name, kind, size in json.loads(data[4:at]):
        out[name] = unsqueeze(data[at:at + size], kind, in_steps(name, kind))
        at += size
    return out


def joined(arrays: Iterable[np.ndarray], dtype: str = "i8") -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *(x.astype(dtype, copy=False) for x in arrays)])


def counted(place: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(place, weights, n).astype(np.int64)


def small(x: np.ndarray) -> np.ndarray:
    return x.astype("<u4") if not len(x) or x.max() < 1 << 32 else x.astype("<u8")


def small_changes(samples: dict[int, np.ndarray], name: str) -> dict[str, np.ndarray]:
    """Samples of the same counts: the first one, then changes, with signs in the lowest bit."""
    out, last = {}, 0
    for s, x in samples.items():
        change = x.astype(np.int64) - last
        out[f"{name}{s}"], last = small(change << 1 ^ change >> 63), x.astype(np.int64)
    return out


def from_changes(arrays: dict[str, np.ndarray], name: str, sweeps: Iterable[int]) -> dict[int, np.ndarray]:
    out, last = {}, 0
    for s in sweeps:
        x = arrays[f"{name}{s}"].astype(np.int64)
        out[s] = last = last + (x >> 1 ^ -(x & 1))
    return out


def _row(part: int, kind: int, src: int, n: int = 0, data: bytes | None = None) -> tuple:
    return int(part), kind, int(src), int(n), data


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of some MB."""
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    names = [f.split(" ")[0] for f in _ROW.split(", ")]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row[4] or b"")
        if size > 16 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[tuple[int, dict[str, np.ndarray]]]]]]:
    """Each part with its rows by kind, as (src, arrays) in the order of src."""
    for table in groups_of(batches, ["part"]):
        found: dict[int, list] = {}
        for kind, src, data in zip(*(table.column(c).to_pylist() for c in ("kind", "src", "data")), strict=True):
            found.setdefault(kind, []).append((src, unpack(data)))
        part = table.column("part")[0].as_py()
        del table
        yield part, found
        found.clear()
        pa.default_memory_pool().release_unused()


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(hashes + U64(0x51ED27)) % U64(parts)).astype(np.int64)


def split(place: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each place with the indices that go there, both in order."""
    order = np.argsort(place, kind="stable")
    if len(order):
        cuts = np.flatnonzero(np.diff(place[order])) + 1
        for at in np.split(order, cuts):
            yield int(place[at[0]]), at


class _Block:
    """Documents of one block until it is full."""

    def __init__(self) -> None:
        self.words: list[np.ndarray] = []
        self.docs: list[tuple[int | None, bool | None]] = []
        self.tokens = 0

    def add(self, doc: int | None, held: bool | None, text: bytes) -> None:
        words = text.lower().split()
        self.words.append(np.append(word_hashes(words), U64(END)))
        self.docs.append((doc, held))
        self.tokens += len(words) + 1

    def row(self, number: int) -> tuple:
        distinct, code = np.unique(np.concatenate(self.words), return_inverse=True)
        # frequent words get small numbers, which compress well
        order = np.argsort(-np.bincount(code), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return _row(number, STATE, 0, self.tokens, pack(
            words=distinct[order], codes=place[code].astype("<u4"), sizes=np.array([len(w) for w in self.words], "<i8"),
            doc=np.array([d or 0 for d, _ in self.docs], "<i8"), null=np.array([d is None for d, _ in self.docs], "u1"),
            held=np.array([2 if h is None else int(h) for _, h in self.docs], "u1")))


def _index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in cut_rows(batches, "text"):
            for doc, held, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(),
                                       byte_list(batch.column("text")), strict=True):
                block.add(doc, held, text or b"")
                if block.tokens >= BLOCK:
                    yield block.row(number)
                    block, number = _Block(), number + 1
        if block.docs:
            yield block.row(number)

    yield from _batches(rows())


def _frequent(batches: Iterable[pa.RecordBatch], parts: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Contexts that hold a good part of a chunk's share of a block."""
    for block, found in _parts(batches):
        for _, x in found[STATE]:
            names, n = np.append(x["words"], U64(START)), np.append(np.bincount(x["codes"]), len(x["sizes"]))
            some = names[n >= max(hot, len(x["codes"]) / (4 * parts))]
            yield from _batches([_row(block, STATE, w) for w in some.view(np.int64)])


class Pairs:
    """The distinct pairs of a block, and the chunks that hold them."""

    def __init__(self, block: dict[str, np.ndarray], hot: np.ndarray, parts: int) -> None:
        n, codes, sizes = len(block["words"]), block["codes"].astype(np.int64), block["sizes"]
        before = np.append(n, codes[:-1])
        before[np.cumsum(sizes) - sizes] = n
        self.names = np.append(block["words"], U64(START))
        # a context's words in the order of their hashes, as in the chunks
        order = np.argsort(block["words"])
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        keys, self.of = np.unique(before * n + rank[codes], return_inverse=True)
        self.context, self.word = keys // n, order[keys % n]
        self.count = counted(self.of[np.repeat(block["held"] == 0, sizes)], len(keys))
        key = self.names[self.context]
        apart = np.isin(self.names, hot)[self.context]
        key[apart] = mix64(key[apart]) + self.names[self.word[apart]]
        self.chunks = list(split(part_of(key, parts)))


def _ask_contexts(batches: Iterable[pa.RecordBatch], hot: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for block, found in _parts(batches):
            for _, x in found[STATE]:
                pairs = Pairs(x, hot, parts)
                for chunk, at in pairs.chunks:
                    contexts, n = np.unique(pairs.context[at], return_counts=True)
                    words, word = np.unique(pairs.word[at], return_inverse=True)
                    yield _row(chunk, MESSAGE, block, 0, pack(u=pairs.names[contexts], n=small(n), w=pairs.names[words],
                                                              word=small(word), count=small(pairs.count[at])))

    yield from _batches(rows())


def _ask_words(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for block, found in _parts(batches):
            for _, x in found[STATE]:
                known = counted(x["codes"][np.repeat(x["held"] == 0, x["sizes"])], len(x["words"]))
                for part, at in split(part_of(x["words"], parts)):
                    yield _row(part, ASKED, block, 0, pack(w=x["words"][at], known=small(known[at])))

    yield from _batches(rows())


def _shares(chunk: int, kind: int, share: np.ndarray, n: np.ndarray, n_hot: int) -> Iterator[tuple]:
    """Sums of what hot contexts hold, one by one, and all others together."""
    for i, x in enumerate(counted(share, n_hot + 1, n).tolist()):
        if x:
            yield _row(chunk, kind, i, x)


def _gather_contexts(batches: Iterable[pa.RecordBatch], hot: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """All blocks' pairs of a chunk: its state, what was asked for, and messages to the parent."""
    def rows() -> Iterator[tuple]:
        for chunk, found in _parts(batches):
            asks = [x for _, x in found[MESSAGE]]
            contexts, u = np.unique(joined((x["u"] for x in asks), "u8"), return_inverse=True)
            words, w = np.unique(joined((x["w"] for x in asks), "u8"), return_inverse=True)
            first = np.cumsum([0, *(len(x["w"]) for x in asks)])
            key = np.repeat(u, joined(x["n"] for x in asks)) * len(words) + w[joined(x["word"] + k for x, k in zip(asks, first, strict=False))]
            pairs, entry = np.unique(key, return_inverse=True)
            total = counted(entry, len(pairs), joined(x["count"] for x in asks))
            context, word = pairs // len(words), pairs % len(words)
            many = total > 1
            number = np.where(many, np.cumsum(many) + 1, total)   # 0: not learned, 1: once, 2..: repeated pairs
            customers = counted(context, len(contexts), total)
            once = counted(context[total == 1], len(contexts))
            share = np.searchsorted(hot, contexts)
            share[~np.isin(contexts, hot)] = len(hot)
            fixed = counted(word[total == 1], len(words))
            # words of repeated pairs in the order of the parts that answer
            to = part_of(words, parts)
            sent = np.unique(word[many])
            sent = sent[np.argsort(to[sent], kind="stable")]
            look = np.full(len(words), -1)
            look[sent] = np.arange(len(sent))
            tables = counted(look[word[many]], len(sent))
            for part, at in split(np.where((fixed > 0) | (look >= 0), to, -1)):
                if part >= 0:
                    mine = sent[to[sent] == part]
                    rest = at[look[at] < 0]
                    yield _row(part, MESSAGE, chunk, 0, pack(w=words[np.append(mine, rest)], fixed=small(fixed[np.append(mine, rest)]),
                                                             tables=small(tables[look[mine]])))
            yield _row(chunk, STATE, 0, 0, pack(u=small(context[many]), w=small(look[word[many]]), count=small(total[many]),
                                                once=small(once), share=small(share), to=small(to[sent])))
            yield _row(chunk, SEATS, 0, 0, pack(tables=np.ones(int(many.sum()), "<u4")))
            number = number[entry]
            yield _row(chunk, ASKED, 0, 0, pack(
                block=np.array([src for src, _ in found[MESSAGE]], "<i8"), n=small(joined(np.array([x["n"].sum()]) for x in asks)),
                kinds=np.minimum(number, 2).astype("u1"), ids=small(number[number > 1]), n_u=np.array([len(x["u"]) for x in asks], "<u4"), u=small(u), customers=small(customers)))
            yield from _shares(chunk, CUSTOMERS, share, customers, len(hot))
            yield from _shares(chunk, TABLES, share, once + counted(context[many], len(contexts)), len(hot))

    yield from _batches(rows())


def _reply(part: int, x: dict[str, np.ndarray], customers: np.ndarray, root: np.ndarray) -> Iterator[tuple]:
    """What the parent holds of the words, to each chunk that sends tables of them."""
    for chunk, at in zip(x["chunk"].tolist(), np.split(x["at"], np.cumsum(x["n"])[:-1].astype(int)), strict=False):
        if len(at):
            yield _row(chunk, MESSAGE, part, 0, pack(customers=small(customers[at]), tables=root[at]))


def _gather_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parent's share of the words: state, what was asked for, and replies to the chunks."""
    def rows() -> Iterator[tuple]:
        for part, found in _parts(batches):
            asks, sent = [x for _, x in found[ASKED]], found.get(MESSAGE, [])
            words, w = np.unique(joined((x["w"] for x in asks), "u8"), return_inverse=True)
            known = counted(w, len(words), joined(x["known"] for x in asks))
            at = [np.searchsorted(words, x["w"]) for _, x in sent]
            fixed = counted(joined(at), len(words), joined(x["fixed"] for _, x in sent))
            route = [a[:len(x["tables"])] for a, (_, x) in zip(at, sent, strict=True)]
            customers = fixed + counted(joined(route), len(words), joined(x["tables"] for _, x in sent))
            root = (known > 0).astype("<u4")
            state = {"known": small(known), "fixed": small(fixed),
                     "chunk": np.array([src for src, _ in sent], "<i8"), "n": np.array([len(r) for r in route], "<u4"), "at": small(joined(route))}
            yield _row(part, STATE, 0, 0, pack(**state))
            yield _row(part, SEATS, 0, 0, pack(root=root))
            yield _row(part, ASKED, 0, 0, pack(block=np.array([src for src, _ in found[ASKED]], "<i8"),
                                               n=np.array([len(x["w"]) for x in asks], "<u4"), at=small(w)))
            yield from _reply(part, state, customers, root)
            yield _row(part, ROOT, 0, np.count_nonzero(known))
            yield _row(part, ROOT, 1, np.count_nonzero(known))

    yield from _batches(rows())


def seat(count: np.ndarray, discount: float, strength: float, others: np.ndarray, base: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables that ``count`` customers of a word take, one after another.  others: tables of
    other words in the restaurant; base: the word's probability in the parent."""
    tables = (count > 0).astype(np.int64)
    order = np.argsort(-count, kind="stable")
    order = order[:np.count_nonzero(count > 1)]
    c, o, p = count[order], others[order], base[order]
    t, seated = np.ones(len(order)), 1
    while len(order):
        live = int(np.searchsorted(-c, -seated, "left"))  # those with more customers than are seated
        if not live:
            break
        step = 1 if seated < SINGLE else max(1, seated // 4)
        new = (strength + discount * (o[:live] + t[:live])) * p[:live]
        chance = new / (new + seated - discount * t[:live])
        if step == 1:
            t[:live] += rng.random(live) < chance
        else:
            t[:live] += rng.binomial(np.minimum(step, c[:live] - seated), np.clip(chance, 0, 1))
        seated += step
    tables[order] = t
    return tables


class Totals:
    """What restaurants share: customers and tables of hot contexts, one by one, and of all
    others together; tables of the root."""

    def __init__(self, sums: list[int]) -> None:
        n = (len(sums) - 2) // 2
        self.customers = np.array(sums[:n], float)
        self.tables = np.array(sums[n:2 * n], float)
        self.root_tables, self.types = float(sums[2 * n]), float(sums[2 * n + 1])

    @property
    def base(self) -> float:
        return 1 / (self.types + 1)

    def root(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The shared parent's predictive probability of words."""
        rest = (ROOT_STRENGTH + ROOT_DISCOUNT * self.root_tables) * self.base
        return (np.maximum(customers - ROOT_DISCOUNT * tables, 0) + rest) / (ROOT_STRENGTH + self.tables.sum())

    def back_off(self) -> np.ndarray:
        return (STRENGTH + DISCOUNT * self.tables) / (STRENGTH + self.customers)

    def of(self, share: np.ndarray, own: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Counts of contexts: a hot one's from what all chunks hold of it, another's own."""
        return np.where(share < len(shared) - 1, shared[share], own)


def _seat_contexts(batches: Iterable[pa.RecordBatch], totals: Totals, sweep: int, keep: bool, seed: int) -> Iterator[pa.RecordBatch]:
    """Seat all repeated pairs of each chunk again.  With ``keep``, the new seats are a sample."""
    def rows() -> Iterator[tuple]:
        for chunk, found in _parts(batches):
            x, replies = found[STATE][0][1], [r for _, r in found.get(MESSAGE, [])]
            probs = totals.root(joined(r["customers"] for r in replies), joined(r["tables"] for r in replies))
            u, w, tables, n = x["u"].astype(np.int64), x["w"].astype(np.int64), found[SEATS][0][1]["tables"].astype(np.int64), len(x["once"])
            held = totals.of(x["share"], x["once"] + counted(u, n, tables), totals.tables)
            rng = np.random.default_rng([seed, sweep, 0, chunk])
            tables = seat(x["count"].astype(np.int64), DISCOUNT, STRENGTH, held[u] - tables, probs[w], rng)
            held = x["once"] + counted(u, n, tables)
            yield _row(chunk, SEATS, sweep, 0, pack(tables=small(tables), **({"held": small(held)} if keep else {})))
            sums = counted(w, len(x["to"]), tables)
            for part, at in split(x["to"]):
                yield _row(part, MESSAGE, chunk, 0, pack(tables=small(sums[at])))
            yield from _shares(chunk, TABLES, x["share"], held, len(totals.tables) - 1)

    yield from _batches(rows())


def _seat_words(batches: Iterable[pa.RecordBatch], totals: Totals, sweep: int, keep: bool, seed: int) -> Iterator[pa.RecordBatch]:
    """Sum the contexts' tables of each word and seat them in the parent."""
    def rows() -> Iterator[tuple]:
        for part, found in _parts(batches):
            x, root = found[STATE][0][1], found[SEATS][0][1]["root"].astype(np.int64)
            customers = x["fixed"] + counted(x["at"], len(root), joined(m["tables"] for _, m in found.get(MESSAGE, [])))
            rng = np.random.default_rng([seed, sweep, 1, part])
            root = small(seat(customers, ROOT_DISCOUNT, ROOT_STRENGTH, totals.root_tables - root, np.full(len(root), totals.base), rng))
            yield _row(part, SEATS, sweep, 0, pack(root=root, **({"customers": small(customers)} if keep else {})))
            yield from _reply(part, x, customers, root)
            yield _row(part, ROOT, 0, root.sum())

    yield from _batches(rows())


def _answer_contexts(batches: Iterable[pa.RecordBatch], kept: dict[int, Totals]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for chunk, found in _parts(batches):
            x, asked, seats = found[STATE][0][1], found[ASKED][0][1], dict(found[SEATS])
            count = np.concatenate([[0, 1], x["count"]])
            total = np.concatenate([[0, len(kept)], sum(seats[s]["tables"].astype(np.int64) for s in kept)])
            last = kept[max(kept)]
            customers = last.of(x["share"], asked["customers"], last.customers)
            held = {s: t.of(x["share"], seats[s]["held"], t.tables) for s, t in kept.items()}
            numbers = asked["kinds"].astype(np.int64)
            numbers[numbers > 1] = asked["ids"]
            for block, number, u in zip(asked["block"].tolist(), np.split(numbers, np.cumsum(asked["n"])[:-1].astype(int)),
                                        np.split(asked["u"], np.cumsum(asked["n_u"])[:-1].astype(int)), strict=True):
                yield _row(block, MESSAGE, chunk, 0, pack(count=small(count[number]), total=small(total[number]), customers=small(customers[u].astype(np.int64)),
                                                          **small_changes({s: h[u] for s, h in held.items()}, "held")))

    yield from _batches(rows())


def _answer_words(batches: Iterable[pa.RecordBatch], sweeps: list[int]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for part, found in _parts(batches):
            x, asked, seats = found[STATE][0][1], found[ASKED][0][1], dict(found[SEATS])
            for block, at in zip(asked["block"].tolist(), np.split(asked["at"], np.cumsum(asked["n"])[:-1].astype(int)), strict=True):
                yield _row(block, ASKED, part, 0, pack(known=x["known"][at], **{
                    k: v for name in ("customers", "root") for k, v in small_changes({s: seats[s][name][at] for s in sweeps}, name).items()}))

    yield from _batches(rows())


def _score(batches: Iterable[pa.RecordBatch], kept: dict[int, Totals], hot: np.ndarray, parts: int, n_tokens: int, n_types: int) -> Iterator[pa.RecordBatch]:
    for _, found in _parts(batches):
        x = found[STATE][0][1]
        n, codes, start = len(x["words"]), x["codes"], np.cumsum(x["sizes"]) - x["sizes"]
        known, roots = np.zeros(n), {s: np.zeros(n) for s in kept}
        answers = dict(found[ASKED])
        for part, at in split(part_of(x["words"], parts)):
            got = answers.pop(part)
            known[at] = got["known"]
            customers, root = (from_changes(got, name, kept) for name in ("customers", "root"))
            for s, t in kept.items():
                roots[s][at] = t.root(customers[s].astype(float), root[s])
        pairs, answers = Pairs(x, hot, parts), dict(found.pop(MESSAGE))
        p = np.zeros(len(pairs.word))
        for chunk, at in pairs.chunks:
            got = answers.pop(chunk)
            u = np.unique(pairs.context[at], return_inverse=True)[1]
            size = STRENGTH + got["customers"][u]
            p[at] = np.maximum(got["count"] - DISCOUNT * got["total"] / len(kept), 0) / size
            for s, held in from_changes(got, "held", kept).items():
                p[at] += (STRENGTH + DISCOUNT * held[u]) / size * roots[s][pairs.word[at]] / len(kept)
        base = np.log10((known + 1) / (n_tokens + n_types + 1))
        held = [None if h == 2 else bool(h) for h in x["held"].tolist()]
        doc = [None if null else d for d, null in zip(x["doc"].tolist(), x["null"].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([
            pa.array(doc, pa.int64()), pa.array(held, pa.bool_()), pa.array(x["sizes"], pa.int64()),
            pa.array(np.add.reduceat((known[codes] > 0).astype(np.int64), start), pa.int64()), pa.array(np.full(len(doc), n_tokens), pa.int64()),
            pa.array(np.add.reduceat(base[codes], start)), pa.array(np.add.reduceat(np.log10(p)[pairs.of], start))],
            names=[f.split(" ")[0] for f in _SCORES.split(", ")])


def pin_kinds(rows: DataFrame, name: str) -> DataFrame:
    """Like ``pin_table``, with a folder for each kind, so that later reads skip the others."""
    path = fresh_path(rows.sparkSession, name)
    rows.write.partitionBy("kind").parquet(path)
    return rows.sparkSession.read.schema(_ROW).parquet(path).select(rows.columns)


def _sums(rows: DataFrame, kind: int, n: int) -> list[int]:
    got = {r["src"]: r["n"] for r in rows.filter(F.col("kind") == kind).groupBy("src").agg(F.sum("n").alias("n")).collect()}
    return [got.get(i, 0) for i in range(n)]


def score_documents(docs: DataFrame, held_out: Column, burn_in: int = 2, samples: int = 3, seed: int = 1, hot: int = HOT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of
    ``docs``.  ``held_out``, a condition on doc_id, tells what is not learned from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", held_out)
    index = pin_table(rows.mapInArrow(_index, _ROW), "index")
    # chunks follow the tokens alone: messages are a row for each two parts
    parts = max(1, -(-(index.agg(F.sum("n")).first()[0] or 0) // CHUNK))

    def dealt(*tables: DataFrame) -> DataFrame:
        out = tables[0]
        for t in tables[1:]:
            out = out.unionByName(t)
        return out.repartition(parts, "part").sortWithinPartitions("part", "kind", "src")

    def of(table: DataFrame, kind: int) -> DataFrame:
        return table.filter(F.col("kind") == kind)

    frequent = np.array(sorted(r["src"] for r in index.mapInArrow(lambda x: _frequent(x, parts, hot), _ROW).select("src").distinct().collect()), "i8")
    names = np.sort(frequent.view("u8"))
    n = len(names) + 1
    contexts = pin_kinds(dealt(index.mapInArrow(lambda x: _ask_contexts(x, names, parts), _ROW))
                         .mapInArrow(lambda x: _gather_contexts(x, names, parts), _ROW), "contexts")
    words = pin_kinds(dealt(index.mapInArrow(lambda x: _ask_words(x, parts), _ROW), of(contexts, MESSAGE)).mapInArrow(_gather_words, _ROW), "words")
    # what no sweep changes
    of_contexts, of_words = (of(contexts, STATE), of(contexts, ASKED)), (of(words, STATE), of(words, ASKED))
    customers, root = _sums(contexts, CUSTOMERS, n), _sums(words, ROOT, 2)
    n_tokens, n_types = sum(customers), root[1]
    totals = Totals([*customers, *_sums(contexts, TABLES, n), *root])
    kept: dict[int, Totals] = {}
    seats: list[tuple[DataFrame, DataFrame]] = []
    for sweep in range(burn_in + samples):
        keep = sweep >= burn_in
        contexts = pin_table(dealt(of_contexts[0], of(contexts, SEATS), of(words, MESSAGE)).mapInArrow(
            lambda x, t=totals, s=sweep, k=keep: _seat_contexts(x, t, s, k, seed), _ROW), f"contexts{sweep}")
        words = pin_table(dealt(of_words[0], of(words, SEATS), of(contexts, MESSAGE)).mapInArrow(
            lambda x, t=totals, s=sweep, k=keep: _seat_words(x, t, s, k, seed), _ROW), f"words{sweep}")
        totals = Totals([*customers, *_sums(contexts, TABLES, n), *_sums(words, ROOT, 1), n_types])
        if keep:
            kept[sweep] = totals
            seats.append((of(contexts, SEATS), of(words, SEATS)))
    answers = (dealt(*of_contexts, *(c for c, _ in seats)).mapInArrow(lambda x: _answer_contexts(x, kept), _ROW),
               dealt(*of_words, *(w for _, w in seats)).mapInArrow(lambda x: _answer_words(x, list(kept)), _ROW))
    return dealt(index, *answers).mapInArrow(lambda x: _score(x, kept, names, parts, n_tokens, n_types), _SCORES)
