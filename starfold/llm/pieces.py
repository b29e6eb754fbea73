"""SentencePiece encoding with seeded merge-dropout, and decoding.

Encoding is that of a merge-type (BPE) model: the symbols of a word are
merged pair by pair, best score first, leftmost first. With dropout each
candidate pair is skipped when a hash of the seed, the document's id, the
word's place in the text and the pair's place in the word falls below the
dropout rate. The decision belongs to the pair, so it does not depend on the
order of work, on the machine or on the batch, and every occurrence of a word
has decisions of its own. Only a decision on a pair whose turn comes changes
anything, so an occurrence goes through the merges of its word in their order
until one is skipped, and from there through those of the word without that
merge, and so on. What follows is kept: pieces and merges of each word, and
of each word without the merges skipped so far.

White space is kept and characters that the model does not know (and the
model's own blank mark, when a text holds it) become byte pieces, so that
decoding restores every text exactly, whatever was skipped.

All words of a batch go through their agendas together: rows of equal length,
one merge in each row at a time.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import tokens as T
from starfold.llm.base import table
from starfold.llm.spans import SpanCache, gather

MARK = "▁"  # stands for a blank in pieces
DROPOUT, SEED = 0.1, 2024
#: Words of up to this many symbols (63 at most) are handled together; longer ones one by one.
TOGETHER = 48
#: Their lengths are rounded up to a multiple of this.
ROUND = 4
#: Words whose decisions are drawn together.
PART = 1 << 18
#: Bytes of text that are encoded together.
SLICE = 1 << 20
NEVER = np.int32(1 << 30)

_A, _B, _C = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def skipped(word: np.ndarray, begin, middle, end, rate: float) -> np.ndarray:
    """Is the candidate merge of [begin, middle) and [middle, end) of a keyed word skipped?"""
    at = sum(np.atleast_1d(np.asarray(x, np.uint64)) * odd for x, odd in ((begin, _A), (middle, _B), (end, _C)))
    return (T.mix(word ^ T.mix(at)) >> np.uint64(11)) < np.uint64(rate * (1 << 53))  # 53 bits, as in a double


def _without(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The matrix without one value in each row, that at ``at``."""
    keep = np.ones(x.shape, dtype=bool)
    keep[np.arange(len(x)), at] = False
    return x[keep].reshape(len(x), -1)


class Model:
    """Pieces of a merge-type SentencePiece model and the pairs that make them."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.names = [sp.id_to_piece(i) for i in range(n)]
        plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
        self.byte = np.full(256, -1, dtype=np.int64)
        for i in range(n):
            if sp.is_byte(i):
                self.byte[int(self.names[i][3:5], 16)] = i
        if (self.byte < 0).any():
            raise ValueError("the model has no byte pieces: unknown characters could not be restored")
        ids = {p: i for i, p in enumerate(self.names) if plain[i]}
        if any(MARK in p.lstrip(MARK) for p in ids):
            raise ValueError("the model has pieces that go on after a word's end")
        self.symbol = np.full(0x110000, -1, dtype=np.int32)  # code point to piece
        for p, i in ids.items():
            if len(p) == 1:
                self.symbol[ord(" " if p == MARK else p)] = i
        self.symbol[ord(MARK)] = -1
        by_score = sorted(ids.values(), key=lambda i: -sp.get_score(i))
        rank = np.zeros(n, dtype=np.int32)
        rank[by_score] = np.arange(len(by_score))
        pairs = sorted({(ids[p[:c]] * (n + 1) + ids[p[c:]], i) for p, i in ids.items() for c in range(1, len(p))
                        if p[:c] in ids and p[c:] in ids})
        self.n = n
        pair = np.array([k for k, _ in pairs], dtype=np.int64)
        # Pairs by a hash of so many bits that few share one; ``table`` has the first pair of each hash.
        bits = max(len(pair) * 16, 2).bit_length()
        self.shift = np.uint64(64 - bits)
        place = (pair.view(np.uint64) * _A) >> self.shift
        order = np.argsort(place, kind="stable")
        self.pair = pair[order]
        self.made = np.array([i for _, i in pairs], dtype=np.int32)[order]
        self.rank = rank[self.made]
        self.table = np.minimum(np.searchsorted(place[order], np.arange(1 << bits, dtype=np.uint64)), len(pair) - 1).astype(np.int32)
        self.shared = np.append(place[order][1:] == place[order][:-1], False)  # does the next pair have the same hash?
        text = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() if plain[i] else b""
                for i, p in enumerate(self.names)]
        self.bytes_size = np.array([len(t) for t in text], dtype=np.int64)
        self.bytes_begin = np.cumsum(self.bytes_size) - self.bytes_size
        self.bytes_flat = np.frombuffer(b"".join(text), dtype=np.uint8)
        self.cache = SpanCache()  # words without skips
        self.skips = SpanCache()  # words without some of their merges

    def merges(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NEVER: no piece) and piece of each pair."""
        key = a.astype(np.int64) * (self.n + 1) + b
        at = self.table[(key.view(np.uint64) * _A) >> self.shift]
        hit = self.pair[at] == key
        lost = self.shared[at] & ~hit
        while lost.any():  # pairs that share a place stand side by side
            at[lost] += 1
            hit[lost] = self.pair[at[lost]] == key[lost]
            lost &= self.shared[at] & ~hit
        return np.where(hit, self.rank[at], NEVER), self.made[at]

    def one_word(self, symbols: list[int], word: int, rate: float) -> list[int]:
        """One word's agenda: pieces of its symbols (all known)."""
        n = len(symbols)
        sym, prev, nxt = list(symbols), list(range(-1, n - 1)), [*range(1, n), -1]
        begin = list(range(n))
        agenda: list[tuple[int, int, int, int, int]] = []
        key = np.array([word], dtype=np.uint64)

        def offer(i: int) -> None:
            j = nxt[i] if i >= 0 else -1
            if j < 0:
                return
            rank, made = self.merges(np.array([sym[i]]), np.array([sym[j]]))
            stop = begin[nxt[j]] if nxt[j] >= 0 else n
            if rank[0] < NEVER and not (rate and skipped(key, [begin[i]], [begin[j]], [stop], rate)[0]):
                heapq.heappush(agenda, (int(rank[0]), begin[i], int(made[0]), i, stop))

        for i in range(n - 1):
            offer(i)
        alive = [True] * n
        while agenda:
            rank, _, made, i, stop = heapq.heappop(agenda)
            j = nxt[i] if alive[i] else -1
            if j < 0 or (begin[nxt[j]] if nxt[j] >= 0 else n) != stop:
                continue
            now, same = self.merges(np.array([sym[i]]), np.array([sym[j]]))
            if int(now[0]) != rank or int(same[0]) != made:
                continue
            sym[i], alive[j] = made, False
            nxt[i] = nxt[j]
            if nxt[j] >= 0:
                prev[nxt[j]] = i
            offer(prev[i])
            offer(i)
        out, i = [], 0
        while i >= 0:
            out.append(sym[i])
            i = nxt[i]
        return out

    def many_words(self, sym: np.ndarray, skip: np.ndarray,
                   since: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words as rows of ``sym`` (filled up with ``n``), without the merges ``skip`` (codes for each row; 0: none).

        All pieces from the left, how many of each row, and row and code of
        each merge, in order; of a row, those after its first ``since`` ones.
        """
        rows, size = sym.shape
        wide = size + 1  # a last column that no pair reaches; what stands left of a row's first piece is such a place, too
        real = sym < self.n
        piece = np.full((rows, wide), self.n, dtype=np.int32)
        piece[:, :size] = sym
        there = np.zeros((rows, wide), dtype=bool)
        there[:, :size] = real
        after = np.minimum(np.arange(1, wide + 1, dtype=np.int32), size) + np.zeros((rows, 1), np.int32)
        before = np.arange(-1, size, dtype=np.int32) + np.zeros((rows, 1), np.int32)
        begin = np.arange(size - 1, dtype=np.int32)
        rank, made = np.full((rows, wide), NEVER, dtype=np.int32), np.zeros((rows, wide), dtype=np.int32)
        first, made[:, : size - 1] = self.merges(piece[:, : size - 1], piece[:, 1:size])
        if skip.shape[1]:
            code = begin | begin + 1 << 6 | begin + 2 << 12
            for column in skip.T:
                first[code == column[:, None]] = NEVER
        rank[:, : size - 1] = first
        log: list[tuple[np.ndarray, np.ndarray]] = []
        row, step = np.arange(rows), 0
        flat = [x.reshape(-1) for x in (piece, there, after, before, made)]
        piece_, there_, after_, before_, made_ = flat
        while len(row):
            r = np.arange(len(row))
            a = rank.argmin(axis=1)
            go = rank[r, a] < NEVER
            if not go.all():  # rows that are done leave
                row, rank, a = row[go], rank[go], a[go]
                if not len(row):
                    break
                r = r[: len(row)]
                skip, since = skip[go], since[go]
            base, here = row * wide, r * wide
            rank_ = rank.reshape(-1)
            b = after_[base + a]
            c = after_[base + b]
            new = since <= step
            log.append((row[new], (a | b << 6 | c << 12)[new]))
            step += 1
            piece_[base + a] = made_[base + a]
            there_[base + b] = False
            after_[base + a], before_[base + c] = c, a
            rank_[here + b] = NEVER
            # The piece is offered with the one before it, and with the one after it.
            p, d = before_[base + a], after_[base + c]
            left, right = np.concatenate([p, a]), np.concatenate([a, c])
            both = np.concatenate([base, base])
            ranks, makes = self.merges(piece_[both + left], piece_[both + right])
            if skip.shape[1]:
                code = left | right << 6 | np.concatenate([c, d]) << 12
                ranks = np.where((code.reshape(2, -1, 1) == skip).any(axis=2).reshape(-1), NEVER, ranks)
            rank_[np.concatenate([here, here]) + left] = ranks
            made_[both + left] = makes
        many = there.sum(axis=1)
        log.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
        return piece[there], many, np.concatenate([m[0] for m in log]), np.concatenate([m[1] for m in log])

    def encode(self, texts: list[str], keys: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """Flat piece ids of all texts, and the number of ids of each.

        ``keys``: a number for each text on which, with a word's place in
        the text, the skipped merges depend.
        An empty text has no pieces.
        """
        code = np.frombuffer("".join([" " + t if t else "" for t in texts]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        size = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
        ends = np.cumsum(size)
        if not len(code):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        sym = self.symbol[code]
        blank, strange = code == 32, sym < 0
        first = np.ones(len(code) + 1, dtype=bool)
        first[1:-1] = (blank[1:] & ~blank[:-1]) | strange[1:] | strange[:-1]
        first[ends] = True
        begin = np.flatnonzero(first)
        begin, end = begin[:-1], begin[1:]
        text = np.searchsorted(ends, begin, side="right")
        word = T.span_hashes(code, begin, end) ^ T.mix((end - begin).astype(np.uint64))
        place = (begin - (ends - size)[text]).astype(np.uint64)
        key = T.mix(T.mix(keys[text]) ^ place * _A)
        parts = [self._words(code, sym, begin[i : i + PART], end[i : i + PART], word[i : i + PART], key[i : i + PART], rate)
                 for i in range(0, len(begin), PART)]
        total = np.concatenate([[0], np.cumsum(np.concatenate([m for _, m in parts]))])
        cut = np.searchsorted(begin, np.concatenate([[0], ends]))
        return np.concatenate([f for f, _ in parts]), np.diff(total[cut])

    def _words(self, code, sym, begin, end, word, key, rate) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of occurrences of words (``key``: on which their decisions depend), and each one's number of ids."""
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, flat ids, sizes
        size = end - begin
        alone = (size > TOGETHER) & (sym[begin] >= 0)
        if rate:
            for w in np.flatnonzero(alone).tolist():
                ids = np.array(self.one_word(sym[begin[w] : end[w]].tolist(), int(key[w]), rate), dtype=np.int64)
                parts.append((np.array([w]), ids, np.array([len(ids)])))
        live, node = np.flatnonzero(~alone) if rate else np.arange(len(begin)), word
        own, off = np.zeros(0, np.int64), np.zeros(0, np.int32)  # merges skipped so far, by word
        since = np.zeros(len(begin), dtype=np.int64)  # merges made before the last skipped one
        cache = self.cache
        while len(live):
            def new(at, live=live, own=own, off=off):
                return self._new(code, sym, begin, end, live[at], own, off, since[live[at]])

            got = gather(*(found := cache.sequences(node[live], new)))
            owner = np.repeat(np.arange(len(live)), found[2])
            merge = got < 0  # merges stand behind the ids
            ids, n = got[~merge], np.bincount(owner[~merge], minlength=len(live))
            more = np.zeros(len(live), dtype=bool)
            if rate:
                cand, mine = -got[merge], owner[merge]
                hit = np.flatnonzero(skipped(key[live[mine]], cand & 63, cand >> 6 & 63, cand >> 12, rate))
                hit = hit[np.flatnonzero(np.diff(mine[hit], prepend=-1))]  # the first skipped one of each
                more[mine[hit]] = True
            parts.append((live[~more], ids[np.repeat(~more, n)], n[~more]))
            if not more.any():
                break
            next_live, cand = live[mine[hit]], cand[hit]
            since[next_live] += hit - np.searchsorted(mine, mine[hit])
            stay = np.zeros(len(begin), dtype=bool)
            stay[next_live] = True
            old = stay[own]
            own, off = np.concatenate([own[old], next_live]), np.concatenate([off[old], cand])
            node = node.copy()
            node[next_live] = T.mix(node[next_live] ^ T.mix(cand.astype(np.uint64)))
            live, cache = next_live, self.skips
        many = np.zeros(len(begin), dtype=np.int64)
        for w, _, m in parts:
            many[w] = m
        to = np.cumsum(many) - many
        flat = np.zeros(int(many.sum()), dtype=np.int32)
        for w, ids, m in parts:
            flat[gather(np.arange(len(flat)), to[w], m)] = ids
        return flat, many

    def _new(self, code, sym, begin, end, words, own, off, since) -> tuple[np.ndarray, np.ndarray]:
        """For each of ``words``: its ids, and behind them, negative, its merges after the first ``since`` ones.

        ``own, off``: the skipped merges, by word.
        """
        begin, end = begin[words], end[words]
        size = end - begin
        strange = sym[begin] < 0  # such a character stands alone
        slot = np.full(int(max(words.max(), own.max(initial=0))) + 1, -1)
        slot[words] = np.arange(len(words))
        mine = slot[own] >= 0
        own, off = slot[own[mine]], off[mine]
        off = off[np.argsort(own, kind="stable")]
        first = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(words)))])
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        wide = -(-size // ROUND) * ROUND  # words of like length go together
        for n in np.unique(wide[~strange & (size <= TOGETHER)]).tolist():
            which = np.flatnonzero(~strange & (wide == n) & (size <= TOGETHER))
            for i in range(0, len(which), 1 << 15):
                w = which[i : i + (1 << 15)]
                less = first[w + 1] - first[w]
                without = np.zeros((len(w), int(less.max())), dtype=np.int64)
                without[np.arange(without.shape[1]) < less[:, None]] = gather(off, first[w], less)
                at = np.arange(n) < size[w][:, None]
                mine = np.full(at.shape, self.n, dtype=np.int32)
                mine[at] = gather(sym, begin[w], size[w])
                out, many, row, merge = self.many_words(mine, without, since[w])
                parts.append((w, out, many))
                parts.append((w, -merge[np.argsort(row, kind="stable")], np.bincount(row, minlength=len(w))))
        for w in np.flatnonzero(strange | (size > TOGETHER)).tolist():
            if strange[w]:
                ids = self.byte[list(chr(code[begin[w]]).encode("utf-8", "surrogatepass"))]
            else:
                ids = np.array(self.one_word(sym[begin[w] : end[w]].tolist(), 0, 0.0), dtype=np.int64)
            parts.append((np.array([w]), ids, np.array([len(ids)])))
        many = np.zeros(len(begin), dtype=np.int64)
        for w, _, m in parts:
            many[w] += m
        to = np.cumsum(many) - many
        flat = np.zeros(int(many.sum()), dtype=np.int32)
        for w, x, m in parts:
            flat[gather(np.arange(len(flat)), to[w], m)] = x
            to[w] += m
        return flat, many

    def decode(self, flat: np.ndarray, many: np.ndarray) -> list[bytes]:
        """The UTF-8 texts of piece ids."""
        size = self.bytes_size[flat]
        data = gather(self.bytes_flat, self.bytes_begin[flat], size).tobytes()
        total = np.concatenate([[0], np.cumsum(size)])
        cut = total[np.concatenate([[0], np.cumsum(many)])].tolist()
        return [data[a + 1 : b] for a, b in zip(cut[:-1], cut[1:], strict=True)]  # without the leading blank


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    """This worker's copy of a model file."""
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _keys(ids: pa.Array, seed: int) -> np.ndarray:
    """A key for each document id, of seed and id. Null counts as 0."""
    own = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return T.mix(own ^ T.mix(np.array([seed], np.uint64)))


def _encoded(batches, path: str, rate: float, seed: int) -> Iterator[tuple[pa.Array, list[bytes], np.ndarray, np.ndarray]]:
    for batch in batches:
        ids = batch.column(0)
        keys = _keys(ids, seed)
        for a, b, texts in T.parts(batch.column(1), SLICE):
            whole = [t.decode("utf-8", "surrogatepass") for t in texts]
            yield ids[a:b], texts, *model(path).encode(whole, keys[a:b], rate)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, path: str, rate: float = DROPOUT, seed: int = SEED,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, pieces`` (ids) for each row, over whole texts.

    ``rate`` 0 gives the model's own segmentation. Null and empty texts have
    no pieces. Repeated rows are encoded alike; a null id takes the key of
    id 0; further columns are ignored, whatever their names.
    """

    def run(batches):
        for ids, _, flat, many in _encoded(batches, path, rate, seed):
            ends = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))],
                                             ["doc_id", "pieces"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, pieces array<int>")


def decode(pieces: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, pieces``; no or null pieces give an empty text."""

    def run(batches):
        for batch in batches:
            col = batch.column(1)
            many = np.array([len(x) if x is not None else 0 for x in col.to_pylist()], dtype=np.int64)
            flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = [t.decode("utf-8", "replace") for t in model(path).decode(flat, many)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return pieces.select("doc_id", "pieces").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, rate: float = DROPOUT, seed: int = SEED,
               id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Each document encoded and decoded again.

    Columns: ``doc_id, n_pieces, ids_crc32`` (of the ids as little-endian
    unsigned 32-bit numbers), ``restored`` (the decoded text is the text),
    and with ``keep`` also ``pieces``.
    """

    def run(batches):
        for ids, texts, flat, many in _encoded(batches, path, rate, seed):
            cut = np.concatenate([[0], np.cumsum(many)]).tolist()
            data = memoryview(flat.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            same = [x == y for x, y in zip(model(path).decode(flat, many), texts, strict=True)]
            cols = [ids, pa.array(many), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
            if keep:
                cols.append(pa.ListArray.from_arrays(pa.array(np.array(cut, np.int32)), pa.array(flat, pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names)

    names = ["doc_id", "n_pieces", "ids_crc32", "restored", *["pieces"] * keep]
    schema = "doc_id long, n_pieces long, ids_crc32 long, restored boolean" + ", pieces array<int>" * keep
    return _rows(docs, id_col, text_col).mapInArrow(run, schema)


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with merge-dropout, and whether decoding restores it."""
    return round_trip(table(spark, sf_dir, "documents"), default_model())


QUERIES = {"op9_pieces": op9_pieces}
SQL: dict[str, str] = {}
