"""Token ids in Arrow files of equal-length sequences.

Documents are encoded with a tokenizer file, an end id closes each, and the ids follow one another
in the order of doc_id. A shard is two files in the Arrow file format (record batches that can be
read in any order):

``<name>.arrow``       ``tokens``: fixed_size_list<uint16 or uint32, by vocabulary>[length], ``mask``: fixed_size_list<bool>[length]
                       (true on tokens, false on the padding of a shard's last sequence)
``<name>.docs.arrow``  one row per document: its columns, ``start`` within the shard, ``n_tokens``

Every batch of sequences but the last has the same number of rows, so sequence ``i`` is row
``i % rows`` of batch ``i // rows``: a memory-mapped shard gives it as a numpy view, without a copy.

A task writes files of its own under a random name and reports them only when they are complete;
the manifest holds the reported ones. A retried or doubled task leaves unreported files and
nothing else, so lost executors do no harm.

Defined cases: null text has the end id only; the content of an added token in a text gives that
token's id, as in the library; documents with equal or null ids follow one another
in the order of their text's hash (null ids first); an empty table gives no shard and an empty
result; other columns are left out unless named.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripgrid.llm.common import stored
from tripgrid.session import scratch_dir

KEPT_WORDS = 1_200_000
WORDS_AT_ONCE = 2_000
TAILS = b",."
# Latin letters that normalising and lower-casing leave single letters
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ɏ]+")
CHARS_AT_ONCE = 1_000_000


class WordMemo:
    """The tokenizers library behind a memory of words.

    The vocabulary's rules never join anything across white space, so a text's ids are those of its
    words one after another; only words not met before go to the library. Many go in one string,
    with a mark between them whose id no word without that character has.

    Names of added tokens are ordinary words to it; texts that hold one are the `TextEncoder`'s.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        (self.mark,) = self._encode(["\0"])[0]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.tails = np.zeros(256, np.uint32)
        for c in TAILS:
            (self.tails[c],) = self._encode([chr(c)])[0]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.empty(1 << 16, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _ask(self, new: list[bytes]) -> None:
        """Learn words from the library.

        Words of letters alone are never cut, so their ends show in the tokens that end a word;
        between the others goes a mark, and those with the mark's character go one by one.
        """
        texts = [w.decode() for w in new]
        whole = [t for t in texts if LETTERS.fullmatch(t)]
        mixed = [t for t in texts if "\0" not in t and not LETTERS.fullmatch(t)]
        alone = [t for t in texts if "\0" in t]
        at_once = range(0, max(len(whole), len(mixed)), WORDS_AT_ONCE)
        ids = np.concatenate([np.empty(0, np.uint32), *self._encode([" ".join(whole[k : k + WORDS_AT_ONCE]) for k in at_once])])
        self._keep(whole, ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1))
        ids = np.concatenate(
            [np.empty(0, np.uint32), *self._encode([" \0 ".join([*part, ""]) for k in at_once if (part := mixed[k : k + WORDS_AT_ONCE])])]
        )
        marks = np.flatnonzero(ids == self.mark)
        self._keep(mixed, np.delete(ids, marks), np.diff(marks, prepend=-1) - 1)
        single = self._encode(alone)
        self._keep(alone, np.concatenate([np.empty(0, np.uint32), *single]), np.array([len(x) for x in single], np.int64))

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first, n = len(self.known), len(words)
        while first + n > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.start[first : first + n] = self.used + np.cumsum(sizes) - sizes
        self.length[first : first + n] = sizes
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.known.update(zip(map(str.encode, words), range(first, first + n), strict=True))

    def _learn(self, new: set[bytes]) -> None:
        """A letter and a comma or stop after it are always cut apart, and case is dropped, so
        words are learned from their lower-case stems."""
        stems, tails = [], []
        for w in new:
            stem = w.lower()
            cut = len(stem) > 1 and stem[-1] in TAILS and 97 <= stem[-2] <= 122
            stems.append(stem[:-1] if cut else stem)
            tails.append(stem[-1] if cut else 0)
        if ask := sorted(set(stems).difference(self.known)):
            self._ask(ask)
        rest = [(w, s, t) for w, s, t in zip(new, stems, tails, strict=True) if w not in self.known]
        if not rest:
            return
        codes = np.fromiter((self.known[s] for _, s, _ in rest), np.int64, len(rest))
        tail = np.array([t for _, _, t in rest])
        sizes = self.length[codes] + (tail > 0)
        stops = np.cumsum(sizes)
        ids = np.empty(stops[-1], self.flat.dtype)
        at = np.ones(stops[-1], bool)
        at[stops[tail > 0] - 1] = False
        ids[at] = self._gather(codes)
        ids[~at] = self.tails[tail[tail > 0]]
        self._keep([w.decode() for w, _, _ in rest], ids, sizes)

    def _gather(self, codes: np.ndarray) -> np.ndarray:
        """Ids of the words with these codes, one after another."""
        sizes = self.length[codes]
        stops = np.cumsum(sizes)
        return self.flat[np.repeat(self.start[codes] - (stops - sizes), sizes) + np.arange(stops[-1] if len(stops) else 0)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        words: list[bytes] = []
        ends = [0]
        for t in texts:
            words += t.encode().split()
            ends.append(len(words))
        if len(self.known) > KEPT_WORDS or self.used > 4 * KEPT_WORDS:
            self._forget()
        if new := set(words).difference(self.known):
            self._learn(new)
        codes = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        stops = np.concatenate(([0], np.cumsum(self.length[codes])))
        return self._gather(codes), np.diff(stops[ends])


class TextEncoder(WordMemo):
    """Ids as the library gives them with ``add_special_tokens=False`` and no other setting.

    A text that holds the content of an added token goes to the library as it is, because there it
    gives that token's id; all other texts go through the memory of words.
    """

    def __init__(self, path: str) -> None:
        super().__init__(path)
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder().values()
        # the library looks for normalised tokens in the normalised text
        self.exact = [t.content for t in added if not t.normalized]
        self.folded = [t.content for t in added if t.normalized]

    def _special(self, text: str) -> bool:
        if any(x in text for x in self.exact):
            return True
        return bool(self.folded) and any(x in self.library.normalizer.normalize_str(text) for x in self.folded)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        special = [i for i, t in enumerate(texts) if self._special(t)]
        if not special:
            return super().encode(texts)
        own = dict(zip(special, self.library.encode_batch_fast([texts[i] for i in special], add_special_tokens=False), strict=True))
        ids, sizes = super().encode(["" if i in own else t for i, t in enumerate(texts)])
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for i, found in own.items():
            parts[i] = np.array(found.ids, self.flat.dtype)
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)


_memo: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder for each worker process and vocabulary."""
    if path not in _memo:
        _memo.clear()
        _memo[path] = TextEncoder(path)
    return _memo[path]


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Writes one shard; holds one batch of sequences at a time."""

    def __init__(self, folder: str, length: int, rows: int, kind: np.dtype, columns: pa.Schema) -> None:
        self.kind = np.dtype(kind)
        self.name, self.length, self.rows = uuid.uuid4().hex, length, rows
        self.path = f"{folder}/{self.name}.arrow"
        self.files, root = filesystem(folder)
        self.files.create_dir(root, recursive=True)
        self.schema = pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(self.kind), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index = pa.schema([*columns, pa.field("start", pa.int64()), pa.field("n_tokens", pa.int64())])
        self.sinks = [self.files.open_output_stream(f"{root}/{self.name}{end}") for end in (".arrow", ".docs.arrow")]
        self.out = [pa.ipc.new_file(s, x) for s, x in zip(self.sinks, (self.schema, self.index), strict=True)]
        self.waiting: list[np.ndarray] = []
        self.held = self.total = self.docs = 0

    def _put(self, ids: np.ndarray) -> None:
        pad = -len(ids) % self.length
        mask = np.ones(len(ids) + pad, bool)
        if pad:
            ids, mask[-pad:] = np.concatenate([ids, np.zeros(pad, self.kind)]), False
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids.astype(self.kind, copy=False), mask)]
        self.out[0].write_batch(pa.record_batch(columns, schema=self.schema))

    def add(self, columns: list[pa.Array], ids: np.ndarray, sizes: np.ndarray) -> None:
        start = self.total + np.cumsum(sizes) - sizes
        self.out[1].write_batch(pa.record_batch([*columns, pa.array(start), pa.array(sizes.astype(np.int64))], schema=self.index))
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        self.docs += len(sizes)
        full = self.length * self.rows
        if self.held >= full:
            ids = np.concatenate(self.waiting)
            cut = len(ids) // full * full
            for k in range(0, cut, full):
                self._put(ids[k : k + full])
            self.waiting, self.held = [ids[cut:]], len(ids) - cut

    def close(self) -> None:
        if self.held:
            self._put(np.concatenate(self.waiting))
        for x in (*self.out, *self.sinks):
            x.close()


class Shard:
    """Random access to a shard; local files are memory-mapped and sequences are views."""

    def __init__(self, uri: str) -> None:
        files, path = filesystem(uri)
        local = isinstance(files, fs.LocalFileSystem)
        opened = [pa.memory_map(p) if local else files.open_input_file(p) for p in (path, path.removesuffix(".arrow") + ".docs.arrow")]
        self.reader, self.index = (pa.ipc.open_file(x) for x in opened)
        self.length = self.reader.schema.field("tokens").type.list_size
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 1

    def _tokens(self, batch: int) -> np.ndarray:
        return self.reader.get_batch(batch).column("tokens").flatten().to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Tokens and mask of sequence ``i``, both views; the mask's bits stay packed."""
        batch, row = divmod(i, self.rows)
        mask = self.reader.get_batch(batch).column("mask").flatten()
        return self._tokens(batch)[row * self.length : (row + 1) * self.length], mask.slice(row * self.length, self.length)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids ``start .. start + n`` of the shard; a view unless they cross batches."""
        per = self.rows * self.length
        parts = []
        while n > 0:
            batch, at = divmod(start, per)
            take = min(n, per - at)
            parts.append(self._tokens(batch)[at : at + take])
            start, n = start + take, n - take
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.empty(0, np.uint32)])

    def documents(self) -> Iterator[pa.RecordBatch]:
        for k in range(self.index.num_record_batches):
            yield self.index.get_batch(k)


MANIFEST = "path string, lead {kind}, lead_hash long, tokens long, docs long"


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, length: int = 2048, rows: int = 256, folder: str | None = None) -> DataFrame:
    """Write ``doc_id`` and ``text`` as shards; returns the manifest with each shard's global offset.

    A shard is what one task gets of a range partitioning by doc_id, so shards follow one another.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "tokens")
    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("hash"))
    ranged = keyed.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        writer = lead = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                lead = (batch.column("doc_id")[0].as_py(), batch.column("hash")[0].as_py())
                writer = ShardWriter(folder, length, rows, words.flat.dtype, pa.schema([batch.schema.field("doc_id")]))
            texts = batch.column("text")
            sizes = pa.compute.binary_length(texts).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // CHARS_AT_ONCE, prepend=0)).tolist()
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                ids, n = words.encode(texts.slice(a, b - a).to_pylist())
                ids = np.insert(ids, np.cumsum(n), end_id)
                writer.add([batch.column("doc_id").slice(a, b - a)], ids, n + 1)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"path": [writer.path], "lead": pa.array([lead[0]]), "lead_hash": [lead[1]], "tokens": [writer.total], "docs": [writer.docs]}
            )

    manifest = stored(ranged.mapInArrow(run, MANIFEST.format(kind=kind)), "manifest")
    # one row per shard: the running total is the only step over all of them
    w = Window.orderBy(F.col("lead").asc_nulls_first(), "lead_hash").rowsBetween(Window.unboundedPreceding, -1)
    return stored(manifest.withColumn("offset", F.coalesce(F.sum("tokens").over(w), F.lit(0))), "shards")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Documents of the shards of a manifest: doc_id, global start, n_tokens, ids (uint32, little-endian)."""
    kind = dict(manifest.dtypes)["lead"]
    # a stated number of tasks is not merged: one for each shard, however small the manifest is
    tasks = manifest.select("path", "offset").repartition(max(1, manifest.count()), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offset in zip(batch.column("path").to_pylist(), batch.column("offset").to_pylist(), strict=True):
                shard = Shard(path)
                for docs in shard.documents():
                    start, n = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                    ids = [shard.ids(int(a), int(k)).astype("<u4").tobytes() for a, k in zip(start, n, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [docs.column(0), pa.array(start + offset), pa.array(n), pa.array(ids, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    return tasks.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary")
