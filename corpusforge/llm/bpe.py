"""Byte-level BPE over whole texts, with frequent words in a minimal acyclic transducer.

The frequent words of the corpus are compiled, in sorted order, into a minimal acyclic
automaton: equal suffix states are shared, each arc carries an output, and the outputs
along a word add up to its ordinal, which points at the word's ids. The compiled form is
one flat file that every executor maps into memory. Words outside the lexicon are merged
exactly by rank. A bounded memo per task spares repeated walks; it never changes a result.
"""

from __future__ import annotations

import atexit
import hashlib
import heapq
import json
import mmap
import shutil
import struct
import tempfile
import uuid
from collections import Counter
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, checkpoint, lean, narrow, record, strings, tune

#: The public pattern of byte-level BPE, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Below this character all Unicode versions agree on letters, numbers and spaces.
SETTLED = "԰"
LEXICON_WORDS = 50_000
MEMO_ENTRIES = 250_000
COUNT_ENTRIES = 150_000
LONG_WORD = 48


@lru_cache(1)
def byte_letters() -> dict[str, int]:
    """Letter of the vocabulary file -> byte: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, bytes and merge ranks from the text of a tokenizer file."""

    def __init__(self, text: str):
        spec, letters = json.loads(text), byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.pieces = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.pieces[i] = token.encode() if token in self.special else as_bytes(token)
        for token, i in self.special.items():
            self.pieces[i] = token.encode()
        self.letter = [0] * 256
        for c, b in letters.items():
            self.letter[b] = vocab[c]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.packed = {pair: rank << 32 | new for pair, (rank, new) in self.merges.items()}

    @cached_property
    def compiled(self):
        """A compiled merger of single words where ids rise with ranks, else None."""
        import tiktoken

        ids = [new for _, new in self.merges.values()]
        if any(a >= b for a, b in zip(ids, ids[1:])):
            return None
        ranks = {piece: i for i, piece in enumerate(self.pieces) if i not in set(self.special.values())}
        return tiktoken.Encoding("merges", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @cached_property
    def whole(self):
        """The same for whole texts of settled characters, cut into words by the pattern."""
        import tiktoken

        special = set(self.special.values())
        return self.compiled and tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks={p: i for i, p in enumerate(self.pieces) if i not in special}, special_tokens={}).encode_ordinary

    def merge_word(self, word: str) -> list[int]:
        return self.compiled(word) if self.compiled else self.merge(word.encode("utf-8", "replace"))

    def merge(self, word: bytes) -> list[int]:
        """Exact merges in order of rank, leftmost first among equals."""
        ids = [self.letter[b] for b in word]
        return self._short(ids) if len(ids) <= LONG_WORD else self._long(ids)

    def _short(self, ids: list[int]) -> list[int]:
        get, none = self.packed.get, 1 << 60
        ranks = [get(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != none:
            at, new = ranks.index(best), best & 0xFFFFFFFF
            ids[at : at + 2] = [new]
            del ranks[at]
            if at:
                ranks[at - 1] = get((ids[at - 1], new), none)
            if at < len(ranks):
                ranks[at] = get((new, ids[at + 1]), none)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same in n log n: a heap of candidate pairs over a linked list."""
        n, get = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and (y := after[x]) < n and (m := get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[y], m[1]))
        return [x for x in ids if x >= 0]


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic transducer of the words as one flat block of bytes."""
    registry: dict[tuple, int] = {}
    states: list[tuple] = []  # of registered states: (final, ((label, target), ...))
    path: list[list] = [[False, []]]  # of the last word: [final, [(label, target or None)]]

    def freeze(depth: int) -> None:
        while len(path) - 1 > depth:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if (at := registry.get(key)) is None:
                at = registry[key] = len(states)
                states.append(key)
            label, _ = path[-1][1].pop()
            path[-1][1].append((label, at))

    last, ordered = b"", sorted(words)
    for word in ordered:
        same = next((i for i, (x, y) in enumerate(zip(last, word)) if x != y), min(len(last), len(word)))
        freeze(same)
        for label in word[same:]:
            path[-1][1].append((label, None))
            path.append([False, []])
        path[-1][0] = True
        last = word
    freeze(0)
    root = len(states)
    states.append((path[0][0], tuple(path[0][1])))

    below, keys, targets, outputs = [], [], [], []
    for at, (final, arcs) in enumerate(states):  # targets come before their sources
        total = int(final)
        for label, target in arcs:
            keys.append(at << 8 | label)  # rising: words come in order
            targets.append(target)
            outputs.append(total)
            total += below[target]
        below.append(total)
    pool, starts = [], [0]
    for word in ordered:
        pool += words[word]
        starts.append(len(pool))
    parts = [np.array(keys, "<u8"), *(np.array(x, "<u4") for x in (targets, outputs, starts, pool)), np.array([f for f, _ in states], np.uint8)]
    return struct.pack("<8Q", root, len(states), *map(len, parts)) + b"".join(x.tobytes() for x in parts)


class FastIds:
    """Ids alone, without a lexicon: whole settled texts go to a rank encoder, others to the reference tokenizer itself."""

    def __init__(self, vocabulary_text: str):
        import tiktoken
        from tokenizers import Tokenizer

        vocabulary = Vocabulary(vocabulary_text)
        self.special = vocabulary.special
        ranks = {piece: i for i, piece in enumerate(vocabulary.pieces) if i not in set(self.special.values())}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.whole = Tokenizer.from_str(vocabulary_text)
        self.whole.no_truncation()
        self.whole.no_padding()

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if (text.isascii() or max(text) < SETTLED) and not any(s in text for s in self.special):
            return np.array(self.fast(text), "<u4")
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")


class Lexicon:
    """Lookups in a compiled lexicon, whose file is mapped into memory: the workers of an executor share its pages."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.block = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        head, at, views = struct.unpack_from("<8Q", self.block), 64, []
        for size, kind in zip(head[2:], ("<u8", "<u4", "<u4", "<u4", "<u4", "u1")):
            views.append(np.frombuffer(self.block, kind, size, at))
            at += views[-1].nbytes
        self.root = head[0]
        self.keys, self.targets, self.outputs, self.starts, self.pool, self.final = views

    def find(self, words: list[bytes]) -> np.ndarray:
        """The ordinal of each word, -1 for those it lacks: all words walk the automaton side by side, a letter at a time."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        letters, begin = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size
        state, out = np.full(len(words), self.root, np.uint64), np.zeros(len(words), np.int64)
        if not len(self.keys):
            return np.where((size == 0) & (self.final[self.root] > 0), 0, -1)
        live = np.arange(len(words))
        for k in range(int(size.max(initial=0))):
            live = live[size[live] > k]
            if not len(live):
                break
            key = state[live] << np.uint64(8) | letters[begin[live] + k]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[arc] == key
            out[live[~there]] = -1
            live, arc = live[there], arc[there]
            out[live] += self.outputs[arc]
            state[live] = self.targets[arc]
        here = out >= 0
        out[here] = np.where(self.final[state[here].astype(np.int64)] > 0, out[here], -1)
        return out

    def ids(self, ordinal: int) -> bytes:
        return self.pool[self.starts[ordinal] : self.starts[ordinal + 1]].tobytes()

    def get(self, word: bytes) -> list[int] | None:
        ordinal = int(self.find([word])[0])
        return None if ordinal < 0 else np.frombuffer(self.ids(ordinal), "<u4").tolist()


def ship_lexicon(spark: SparkSession, block: bytes) -> str:
    """Hands the file to every executor, once each; its name there."""
    folder = tempfile.mkdtemp(prefix="corpusforge-lexicon-")
    atexit.register(shutil.rmtree, folder, True)
    name = f"{uuid.uuid4().hex}.lexicon"
    with open(f"{folder}/{name}", "wb") as f:
        f.write(block)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


class Encoder:
    """Texts to ids and back. Holds one task's bounded memo."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None = None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.memo: dict[str, bytes] = {}  # of recent chunks; those before them
        self.older: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}  # of words
        self.find = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")").split if vocabulary.special else None
        self.decimal = [str(i) for i in range(len(vocabulary.pieces))]
        self.spaced = np.array([p[:1] == b" " for p in vocabulary.pieces])
        self.merged = vocabulary.whole

    def words(self, text: str) -> list[str]:
        if text.isascii() or max(text) < SETTLED:
            return self.find(text)
        from tokenizers import pre_tokenizers

        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in split.pre_tokenize_str(text)]

    def _exactly(self, text: str) -> bytes:
        return b"".join(map(self._word, self.words(text)))

    def _word(self, word: str) -> bytes:
        if (ids := self.known.get(word)) is None:
            key = word.encode("utf-8", "replace")
            found = self.lexicon.get(key) if self.lexicon else None
            found = self.vocabulary.merge_word(word) if found is None else found
            ids = struct.pack(f"<{len(found)}I", *found)
            if len(word) <= 64:
                if len(self.known) >= MEMO_ENTRIES:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        if len(chunk) > 64:
            return self._exactly(" " + chunk)
        if (ids := self.memo.get(chunk)) is None:
            if len(self.memo) >= MEMO_ENTRIES:
                self.older, self.memo = self.memo, {}
            if (ids := self.older.get(chunk)) is None:
                ids = self._exactly(" " + chunk)
            self.memo[chunk] = ids
        return ids

    def prepare(self, texts: list[str | None]) -> None:
        """Looks up the new chunks of a batch of texts all at once: whole words in the lexicon first, the rest is merged exactly, in one go.
        No chunk holds a space, so the ids that begin with one tell where the next chunk begins."""
        if len(self.memo) >= MEMO_ENTRIES:
            self.older, self.memo = self.memo, {}
        new: dict[str, None] = {}
        for text in texts:
            if text:
                new.update(dict.fromkeys(text.split(" ")[1:]))
        memo, older = self.memo, self.older
        chunks = []
        for c in new:
            if c not in memo and 0 < len(c) <= 64 and not c[0].isspace() and not c[-1].isspace():
                if (ids := older.get(c)) is not None:
                    memo[c] = ids
                else:
                    chunks.append(c)
        if not chunks or not self.merged:
            return
        rest = chunks
        if self.lexicon:
            rest = []
            for c, at in zip(chunks, self.lexicon.find([b" " + c.encode("utf-8", "replace") for c in chunks]).tolist()):
                if at < 0:
                    rest.append(c)
                else:
                    memo[c] = self.lexicon.ids(at)
        rest = [c for c in rest if c.isascii() or max(c) < SETTLED]
        for i in range(0, len(rest), 4096):
            part = rest[i : i + 4096]
            ids = np.array(self.merged(" " + " ".join(part)), "<u4")
            cut = np.append(np.nonzero(self.spaced[ids])[0], len(ids)) * 4
            packed = ids.tobytes()
            if len(cut) != len(part) + 1:  # a word of the vocabulary begins with a space inside a chunk: never for byte-level BPE
                continue
            memo.update(zip(part, map(packed.__getitem__, map(slice, cut[:-1].tolist(), cut[1:].tolist()))))

    def _plain(self, text: str) -> bytes:
        """A single space between two non-spaces always starts a word, so chunks between such spaces are encoded alone. Chunks with white
        space at an end, or of nothing, are encoded together with their neighbours."""
        chunks = text.split(" ")
        out = list(map(self.memo.get, chunks))
        out[0] = None  # no space stands before the first
        rough, i = [], -1
        for _ in range(out.count(None)):
            i = out.index(None, i + 1)
            chunk = chunks[i]
            if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                rough.append(i)
            else:
                out[i] = self._chunk(chunk) if i else self._exactly(chunk)
        k, n = 0, len(chunks)
        while k < len(rough):
            start = max(rough[k] - 1, 0)
            while k + 1 < len(rough) and rough[k + 1] <= rough[k] + 2:
                k += 1
            end = min(rough[k] + 2, n)
            out[start:end] = [self._exactly(" " * (start > 0) + " ".join(chunks[start:end])), *[b""] * (end - start - 1)]
            k += 1
        return b"".join(out)

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers; null counts as empty."""
        if not text:
            return b""
        if self.cut is None or not any(s in text for s in self.vocabulary.special):
            return self._plain(text)
        special = self.vocabulary.special
        return b"".join(struct.pack("<I", special[x]) if x in special else self._plain(x) for x in self.cut(text) if x)

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.vocabulary.pieces.__getitem__, ids)).decode("utf-8", "replace")


_LOCAL: dict[str, object] = {}


def local_encoder(lexicon: str, vocabulary_text) -> Encoder:
    """One encoder per Python worker and run."""
    if _LOCAL.get("key") != lexicon:
        _LOCAL.clear()
        _LOCAL.update(key=lexicon, encoder=Encoder(Vocabulary(vocabulary_text.value), Lexicon(SparkFiles.get(lexicon))))
    return _LOCAL["encoder"]


def count_words(documents: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts. Counts are summed in the task first; a full table is emitted and begun anew."""

    def run(batches: Batches) -> Batches:
        types, find = {"word": pa.string(), "n": pa.int64()}, regex.compile(PATTERN).findall
        chunks: Counter = Counter()

        def flush():
            words: Counter = Counter()
            for chunk, n in chunks.items():
                if chunk.isalpha() and (chunk.isascii() or max(chunk) < SETTLED):
                    words[" " + chunk] += n
                else:
                    for word in find(" " + chunk):
                        words[word] += n
            chunks.clear()
            return record({"word": list(words), "n": list(words.values())}, types)

        for batch in batches:
            for t in strings(batch, "text"):
                if t:
                    chunks.update(t.split(" "))
                    if len(chunks) >= COUNT_ENTRIES:
                        yield flush()
        yield flush()

    return narrow(documents, text=text).mapInArrow(lean(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(documents: DataFrame, text: str = "text", size: int = LEXICON_WORDS) -> list[str]:
    """The corpus's most frequent words: all whose counts lie in the highest classes (factors of 1.09) that hold
    at most size words together. The bound is the lexicon's feature, and that of what the driver gets."""
    counts = checkpoint(count_words(documents, text).filter(F.length("word") <= 64).withColumn("class", F.floor(F.log2("n") * 8).cast("int")))
    room, least = size, None
    for r in sorted(counts.groupBy("class").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["class"]):  # at most 8 x 63 classes
        if r.n > room:
            break
        room, least = room - r.n, r["class"]
    if least is None:
        return []
    return [r.word for r in counts.filter(F.col("class") >= least).select("word").collect()]


def build_lexicon(vocabulary: Vocabulary, words: list[str]) -> bytes:
    return compile_lexicon({w: vocabulary.merge(w) for w in {x.encode("utf-8", "replace") for x in words} if w})


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_decode(documents: DataFrame, vocabulary_path: str, id: str = "doc_id", text: str = "text", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Encodes every whole text and decodes the ids again.

    Returns id, ids array<int>, decoded string. A null or empty text has no ids and decodes to "". Very long texts are encoded whole;
    long words without blanks are merged in n log n.
    Repeated rows are kept; an empty table gives an empty result; other columns are ignored.
    """
    return _run(documents, vocabulary_path, id, text, lexicon_words, digest=False)


def encode_digest(documents: DataFrame, vocabulary_path: str, id: str = "doc_id", text: str = "text", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """As encode_decode, but returns id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256."""
    return _run(documents, vocabulary_path, id, text, lexicon_words, digest=True)


def _run(documents: DataFrame, vocabulary_path: str, id: str, text: str, lexicon_words: int, digest: bool) -> DataFrame:
    spark = documents.sparkSession
    tune(spark)
    source = read_vocabulary(vocabulary_path)
    shared = spark.sparkContext.broadcast(source)
    # At most lexicon_words words of at most 64 characters: bounded, whatever the corpus's size.
    lexicon = ship_lexicon(spark, build_lexicon(Vocabulary(source), frequent_words(documents, text, lexicon_words)))
    df = narrow(documents, id=id, text=text)
    kind = df.schema["id"].dataType.simpleString()
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def run(batches: Batches) -> Batches:
        encoder = local_encoder(lexicon, shared)
        decimal = encoder.decimal.__getitem__
        for batch in batches:
            texts = strings(batch, "text")
            encoder.prepare(texts)
            ids = [encoder.encode(t).tolist() for t in texts]
            keys = batch.column(0)
            if digest:
                columns = [pa.array([len(x) for x in ids], pa.int64()), pa.array([sha(",".join(map(decimal, x)).encode()) for x in ids]), pa.array([sha(encoder.decode(x).encode()) for x in ids])]
                yield pa.RecordBatch.from_arrays([keys, *columns], names=[id, "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.list_(pa.int32())), pa.array([encoder.decode(x) for x in ids], pa.string())], names=[id, "ids", "decoded"])

    out = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    return df.mapInArrow(lean(run), f"`{id}` {kind}, {out}")
