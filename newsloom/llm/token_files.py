"""Token ids as flat unsigned integer files with 64-bit document offsets, read back by memory map.

Documents are range-partitioned and sorted by key, so shard k holds a run of keys and lies before
shard k + 1. A task encodes its rows with the tokenizers library (its model merges
each distinct pre-token once; the pattern splits a text into pre-tokens before any merge, so the ids
are those of the whole text; a text that holds an added token goes through the library whole) and writes

    ids-K.bin      ids, little-endian unsigned 16- or 32-bit
    offsets-K.bin  documents + 1 little-endian 64-bit positions within the shard
    keys-K.bin     the documents' keys, 64-bit

under names that hold its attempt; the shard list, one row per shard, names the files of the attempt
that was committed, so a repeated task cannot mix files. A shard's base is the sum of the id counts
of the shards before it.
"""

import functools
import itertools
import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from newsloom.llm.bpe import Encoder, Vocabulary
from newsloom.llm.texts import chunks

TOKENIZER = "byte_bpe_50k.json"
NO_KEY = -(1 << 63)  # stands for a null key in keys-K.bin; it sorts first, as null does


def tokenizer_path(name=TOKENIZER):
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols():
    """The published character of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@functools.lru_cache(maxsize=2)
def library_encoder(path):
    """(encoder, tokenizer, contents of its added tokens), one per Python worker."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    symbols = byte_symbols()
    special = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
    entries = {
        bytes(symbols[c] for c in token): number
        for token, number in tokenizer.get_vocab(with_added_tokens=False).items()
        if token not in special
    }

    table = {b: c for c, b in symbols.items()}
    model = tokenizer.model

    def merge_all(data, starts, ends):
        tokens = [data[i:j] for i, j in zip(starts, ends, strict=True)]
        written = b"".join(tokens).decode("latin-1").translate(table)  # one symbol for each byte
        stops = [0, *itertools.accumulate(map(len, tokens))]
        return [[x.id for x in model.tokenize(written[i:j])] for i, j in itertools.pairwise(stops)]

    return Encoder(Vocabulary(entries), merge_all, whole=False), tokenizer, [x.encode() for x in sorted(special)]


def encode_chunk(path, buffer, offsets):
    """(ids, firsts) of a chunk as the library encodes each text, without special tokens around it."""
    encoder, tokenizer, added = library_encoder(path)
    ids, firsts = encoder.exact(buffer, offsets)[:2]
    data = buffer.tobytes()
    if not any(x in data for x in added):
        return ids, firsts
    parts = [ids[a:b] for a, b in itertools.pairwise(firsts.tolist())]
    for i, (a, b) in enumerate(itertools.pairwise(offsets.tolist())):
        if any(data.find(x, a, b) >= 0 for x in added):
            parts[i] = np.array(tokenizer.encode(data[a:b].decode(), add_special_tokens=False).ids, ids.dtype)
    return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def _store(folder):
    return fs.FileSystem.from_uri(folder)


def write(docs, folder, key="doc_id", text="text", path=None, end_id=2, width=2, partitions=None):
    """Writes all documents and returns the list of shards: shard, base, n_docs, n_ids, names.

    ``folder`` is a URI or path that all executors share. ``end_id`` follows each document; a null
    or empty text is that id alone. Rows of equal keys are kept, in order of their text; a null key
    is written as ``NO_KEY``. ``width`` is 2 or 4 bytes an id. An empty table gives no shards.
    """
    path = path or tokenizer_path()
    spark = docs.sparkSession
    folder = f"{folder.rstrip('/')}/tokens-{uuid.uuid4().hex}"
    store, root = _store(folder) if "://" in folder or folder.startswith(("file:", "/")) else (fs.LocalFileSystem(), folder)
    store.create_dir(root, recursive=True)
    kind = np.dtype(f"<u{width}")

    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        task = TaskContext.get()
        name = f"{task.partitionId()}-{task.taskAttemptId()}"
        at, n = 0, 0
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        store = _store(folder)[0]
        with (
            store.open_output_stream(f"{root}/ids-{name}.bin") as ids_out,
            store.open_output_stream(f"{root}/offsets-{name}.bin") as offsets_out,
            store.open_output_stream(f"{root}/keys-{name}.bin") as keys_out,
        ):
            offsets_out.write(np.zeros(1, "<i8").tobytes())
            for rows, buffer, offsets in chunks(itertools.chain([first], batches)):
                ids, firsts = encode_chunk(path, buffer, offsets)
                stops = firsts[1:] + np.arange(1, len(firsts))  # with the end ids
                out = np.full(len(ids) + len(stops), end_id, np.int64)
                body = np.ones(len(out), bool)
                body[stops - 1] = False
                out[body] = ids
                if len(out) and out.max() >= 1 << (8 * width):
                    raise ValueError(f"an id needs more than {width} bytes")
                ids_out.write(out.astype(kind).tobytes())
                offsets_out.write((at + stops).astype("<i8").tobytes())
                keys_out.write(np.array(rows.column(0).fill_null(NO_KEY), "<i8").tobytes())
                at, n = at + len(out), n + len(stops)
        yield pa.RecordBatch.from_pydict({"shard": [task.partitionId()], "n_docs": [n], "n_ids": [at], "name": [name]})

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    order = [F.col("key").asc_nulls_first(), F.col("text").asc_nulls_first()]
    dealt = rows.repartitionByRange(*([partitions] if partitions else []), order[0]).sortWithinPartitions(*order)
    shards = sorted(dealt.mapInArrow(run, "shard long, n_docs long, n_ids long, name string").collect())
    base, listed = 0, []
    for shard in shards:  # one row per shard
        listed.append((shard.shard, base, shard.n_docs, shard.n_ids, shard.name))
        base += shard.n_ids
    with store.open_output_stream(f"{root}/shards.json") as out:
        out.write(json.dumps({"width": width, "shards": listed}).encode())
    return spark.createDataFrame(
        [(folder, width, *x) for x in listed],
        "folder string, width int, shard long, base long, n_docs long, n_ids long, name string",
    )


def _array(store, path, kind):
    """The file as an array: memory-mapped on a local store, else read at once."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with store.open_input_file(path) as source:
        return np.frombuffer(source.read(), kind)


def read(shards, key="doc_id", with_ids=False):
    """key, start, n_tokens, ids_crc32 of every document from the files; with ``with_ids`` also ids (binary, 32-bit)."""

    def run(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                store, root = _store(shard["folder"])
                at = lambda what: f"{root}/{what}-{shard['name']}.bin"  # noqa: B023, E731
                offsets, keys = _array(store, at("offsets"), "<i8"), _array(store, at("keys"), "<i8")
                ids = _array(store, at("ids"), f"<u{shard['width']}")
                for i in range(0, len(keys), 2000):
                    spans = offsets[i : i + 2001]
                    raw = [ids[a:b].astype("<u4").tobytes() for a, b in itertools.pairwise(spans.tolist())]
                    own = np.asarray(keys[i : i + 2000])
                    columns = {
                        "key": pa.array(own, mask=own == NO_KEY),
                        "start": shard["base"] + spans[:-1],
                        "n_tokens": np.diff(spans),
                        "ids_crc32": np.array([zlib.crc32(x) for x in raw], np.int64),
                    }
                    if with_ids:
                        columns["ids"] = pa.array(raw, pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)

    schema = "key long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    spread = shards.repartition(max(1, shards.count()), F.col("shard"))
    return spread.mapInArrow(run, schema).withColumnRenamed("key", key)
