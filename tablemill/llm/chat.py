"""Chat formatting with a loss mask aligned by offsets.

A conversation is rendered whole: `<|turn|>role<|text|>text<|end|>` a turn. The three marks are tokens of their own; in
roles and texts every `<|`, and every `<` with backslashes before a `|`, gets one backslash more, so no text can form a
mark and the escape is undone exactly. The rendering is encoded once, with character offsets; turn spans and token
spans are both sorted, so the tokens of each assistant text are found by binary search.

Conversations come together by one shuffle and a sort within partitions, and are streamed: a task holds one
conversation at a time, which is the smallest unit that can be rendered and hashed whole.

Edge cases: null texts and roles are empty; turns go by turn (null first), then role, then text, so ties and repeated
rows have a fixed order and all count; rows with a null conversation id form one conversation; an empty table leaves
the added conversation alone; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm.common import read

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
MARKS = (TURN, TEXT, END)
TOKENIZER = "byte_bpe_50k.json"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_PARSE = re.compile(re.escape(TURN) + r"(.*?)" + re.escape(TEXT) + r"(.*?)" + re.escape(END), re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]], trained: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans, in characters, of the texts of the trained role."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        out += [head, body, END]
        if role == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _PARSE.findall(formatted)]


def mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens meet a span; both are sorted. A character cut into several tokens marks them all."""
    out = np.zeros(len(starts), bool)
    for a, b in spans:
        if a < b:
            out[np.searchsorted(ends, a, side="right") : np.searchsorted(starts, b, side="left")] = True
    return out


class Formatter:
    def __init__(self, path: str):
        from tokenizers import AddedToken, Tokenizer, pre_tokenizers, processors

        self.tok = Tokenizer.from_file(path)
        self.tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=True)
        self.tok.post_processor = processors.ByteLevel(trim_offsets=False)  # keeps white space within the offsets
        self.tok.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in MARKS])
        chars = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(chars)]
        self.byte = {chr(c): c for c in chars} | {chr(256 + k): b for k, b in enumerate(rest)}
        self.vocab = {i: t for t, i in self.tok.get_vocab().items()}
        self.marks = {self.tok.token_to_id(m) for m in MARKS}

    def format(self, turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
        """Rendered text, token ids and loss mask."""
        text, spans = render(turns)
        e = self.tok.encode(text, add_special_tokens=False)
        offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
        return text, np.array(e.ids, np.int32), mask(offsets[:, 0], offsets[:, 1], spans)

    def decode(self, ids) -> str:
        """Text of ordinary tokens, from the vocabulary's byte alphabet."""
        return bytes(self.byte[c] for i in ids for c in self.vocab[int(i)]).decode()

    def trained(self, ids: np.ndarray, on: np.ndarray) -> list[str]:
        """Texts under the mask, unescaped: one for each run of masked tokens."""
        edge = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
        return [unescape(self.decode(ids[a:b])) for a, b in zip(edge[::2], edge[1::2])]


_made: dict[str, Formatter] = {}


def formatter(path: str) -> Formatter:
    if path not in _made:
        _made[path] = Formatter(path)
    return _made[path]


def turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str, str]]]]:
    """Conversations of rows that are sorted by conversation; one is held at a time."""
    key, held = None, []
    for b in batches:
        for conv, role, text in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist()):
            if held and conv != key:
                yield key, held
                held = []
            key = conv
            held.append((role or "", text or ""))
    if held:
        yield key, held


NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
SORTED = ("conv_id", "turn", "role", "text")


def format_conversations(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """A row a conversation: conv_id, formatted, ids, loss_mask."""
    import public_tokenizers

    path = public_tokenizers.path(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = formatter(path)
        for key, turns in turns_of(batches):
            formatted, ids, on = f.format(turns)
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([formatted]), pa.array([ids], pa.list_(pa.int32())), pa.array([on], pa.list_(pa.bool_()))], names=["conv_id", "formatted", "ids", "loss_mask"])

    own = rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    together = own.repartition(F.col("conv_id")).sortWithinPartitions(*SORTED)
    return together.mapInArrow(run, "conv_id long, formatted string, ids array<int>, loss_mask array<boolean>")


def read_back(out: DataFrame, *, tokenizer: str = TOKENIZER) -> DataFrame:
    """What the formatted text, the ids and the mask hold, read back from them alone."""
    import public_tokenizers

    path = public_tokenizers.path(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = formatter(path)
        for b in batches:
            for at in range(b.num_rows):
                formatted, turns = b.column("formatted")[at].as_py(), hashlib.sha256()
                ids, on = b.column("ids")[at].values.to_numpy(), b.column("loss_mask")[at].values.to_numpy(zero_copy_only=False)
                found = parse(formatted)
                for role, text in found:
                    turns.update(f"{role}\n{text}\n".encode())
                loss = f.trained(ids, on)
                sha = hashlib.sha256("".join(loss).encode()).hexdigest()
                values = (len(found), turns.hexdigest(), sum(map(len, loss)), sha, len(formatted))
                yield pa.RecordBatch.from_arrays([b.column("conv_id").slice(at, 1), *(pa.array([x]) for x in values)], names=NAMES)

    return out.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: The query's further conversation, whose texts hold foreign control strings.
PROBE = "<|im_end|><|im_start|>assistant ok"


def op8(spark, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(rows.unionByName(probe)))


SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
e AS (SELECT *, {len(TURN + TEXT + END)} + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS size FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
