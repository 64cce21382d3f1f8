"""Token ids of whole texts by a byte-level BPE file of the ``tokenizers`` library."""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa

from ledgerline.llm.common import at_work

#: White space as the tokenizer's pattern sees it.  Fixed values.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_OTHER = re.compile("[\t\x0b\x0c\r\x85\xa0  -     　]")
_CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Chunks that are kept with their ids; beyond, the table starts anew.
KEPT_CHUNKS = 300_000
#: The pattern that splits text before merging.  Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Chunks of these characters only are of the same classes in every Unicode version.
_PLAIN = re.compile(r"[\x20-\x7e\n\xc0-\u017f]*")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class ChunkIds(dict):
    """chunk -> its ids as little-endian 32-bit integers, made by the library on first use.

    A chunk is a run of white space and the run of other characters after it.
    No token crosses from one chunk into the next.
    """

    def __init__(self, path: str):
        super().__init__()
        self.spaced = SpacedIds(self)
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.fast = _same_merges(self.tokenizer)

    def __missing__(self, chunk: str) -> bytes:
        self[chunk] = out = self.encode(chunk)
        return out

    def encode(self, chunk: str) -> bytes:
        if self.fast and _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            ids = self.fast.encode_ordinary(chunk)
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def ids(self, text: str) -> bytes:
        if len(self) + len(self.spaced) > KEPT_CHUNKS:
            self.clear()
            self.spaced.clear()
        if "  " in text or "\n \n" in text or text.endswith("\n ") or _OTHER.search(text):
            return b"".join(map(self.__getitem__, _CHUNK.findall(text)))
        words = text.split(" ")  # each space opens a chunk
        first = self[words[0]] if words[0] else b""
        words[0] = None
        return first + b"".join(map(self.spaced.__getitem__, words))


class SpacedIds(dict):
    """word -> the ids of a space and the word; None -> none."""

    def __init__(self, chunks: ChunkIds):
        super().__init__()
        self.chunks = chunks
        self[None] = b""

    def clear(self) -> None:
        super().clear()
        self[None] = b""

    def __missing__(self, word: str) -> bytes:
        self[word] = out = self.chunks.encode(" " + word)
        return out


def _same_merges(tokenizer):
    """The file's vocabulary in tiktoken, which encodes short chunks faster; None if its merges aren't in order of ids.

    Special tokens start with ``<|`` in the files this is for; else None too.
    """
    import json

    import tiktoken
    model = json.loads(tokenizer.to_str())
    merges, vocab = model["model"]["merges"], model["model"]["vocab"]
    added = {t["content"] for t in model["added_tokens"]}
    pre = model["pre_tokenizer"] or {}
    if model["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") \
            or not all(x.startswith("<|") for x in added):
        return None
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
    if made != list(range(256, 256 + len(merges))):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    back = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    ranks = {bytes(back[c] for c in token): i for token, i in vocab.items() if token not in added}
    return tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


_made: dict[str, ChunkIds] = {}


def chunk_ids(path: str | None) -> ChunkIds:
    """One table a worker process and file."""
    path = path or default_path()
    at_work("byte_bpe", _made.clear)
    if path not in _made:
        _made[path] = ChunkIds(path)
    return _made[path]


def piece_frames(schema, limit: int, tokenizer: str | None, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow on (id, text): a row per piece of each document."""
    names = [f.name for f in schema.fields]
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_ids(tokenizer)
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = table.ids(text.as_py() or "") + end
                n = len(ids) // 4
                lo, hi = 0, n % limit or limit
                if n <= limit:
                    hi = n
                k = 0
                while lo < n:
                    at.append(i), piece.append(k), start.append(lo), length.append(hi - lo)
                    crc.append(zlib.crc32(memoryview(ids)[4 * lo: 4 * hi]))
                    lo, hi, k = hi, hi + limit, k + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=names)
    return run
