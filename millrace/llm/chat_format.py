"""Conversations formatted by a compiled template, with loss spans, and read back.

Rows are dealt by conversation and sorted by turn within the partition; one task streams its
rows through the template's closures, so a conversation of any length needs the memory of a
few turns only. The result is a table of parts whose texts, joined in order, are the output.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.templates import compile_template

# Control strings of common chat formats. Those of the template below come first.
CONTROLS = ["<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

TURNS = """{% for m in messages %}{{ "<|im_start|>" + m.role | escape }}<|im_sep|>\
{% if m.role == "assistant" %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}<|im_end|>
{% endfor %}"""

PART_CHARS = 65_536
PARTS = "conv_id bigint, part bigint, text string, loss array<struct<start:bigint,end:bigint>>"
_CODES = "0123456789abcdefghijklmnopqrstuvwxyz"


def escaper(controls: list[str]) -> tuple[Callable[[str], str], Callable[[str], str]]:
    """escape and its inverse: a control string becomes a backslash and its code, a backslash becomes two."""
    if len(controls) > len(_CODES):
        raise ValueError(f"at most {len(_CODES)} control strings")
    code = {c: "\\" + _CODES[i] for i, c in enumerate(controls)} | {"\\": "\\\\"}
    back = {v: k for k, v in code.items()}
    hit = re.compile("|".join(re.escape(c) for c in sorted(code, key=len, reverse=True)))
    return lambda text: hit.sub(lambda m: code[m[0]], text), lambda text: re.sub(r"\\(.)", lambda m: back[m[0]], text, flags=re.S)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 256) -> Iterator[pa.RecordBatch]:
    while block := list(itertools.islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema)], schema=schema)


def format_conversations(turns: DataFrame, template: str = TURNS, controls: list[str] | None = None) -> DataFrame:
    """(conv_id, part, text, loss): the formatted conversations in parts of about 64k characters.

    `turns` has conv_id, turn, role and text; further columns are ignored. `loss` holds the
    marked spans of the part, in characters of the whole conversation. Turns are ordered by
    turn, then role, then text, so ties and repeated rows have one order and all stay; a null
    role or text is empty; rows without conv_id form one conversation; an empty table gives
    no rows. A conversation is written in order by one task, which holds one part of it.
    """
    controls = controls or CONTROLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"escape": escaper(controls)[0]})

        def parts() -> Iterator[tuple]:
            for conv, rows in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                number, done, size, texts, spans = 0, 0, 0, [], []
                for text, marked in render({"role": r[1] or "", "text": r[2] or ""} for r in rows):
                    if marked and text:
                        start = done + size
                        if spans and spans[-1]["end"] == start and texts:
                            spans[-1]["end"] += len(text)
                        else:
                            spans.append({"start": start, "end": start + len(text)})
                    texts.append(text)
                    size += len(text)
                    if size >= PART_CHARS:
                        yield conv, number, "".join(texts), spans
                        number, done, size, texts, spans = number + 1, done + size, 0, [], []
                if texts or not number:
                    yield conv, number, "".join(texts), spans

        yield from _batches(parts(), _PARTS)

    rows = turns.select(turns["conv_id"].cast("bigint").alias("conv_id"), "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, PARTS)


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("loss", pa.list_(_SPAN))])
DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_turns(parts: Iterator[str], unescape: Callable[[str], str]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of an output of TURNS, holding one turn and one part at a time."""
    held = ""
    for part in parts:
        held += part
        at = 0
        while (end := held.find("<|im_end|>\n", at)) >= 0:
            role, found, text = held[at + len("<|im_start|>") : end].partition("<|im_sep|>")
            if not found or not held.startswith("<|im_start|>", at):
                raise ValueError("not an output of this template")
            yield unescape(role), unescape(text)
            at = end + len("<|im_end|>\n")
        held = held[at:]
    if held:
        raise ValueError("a turn is not closed")


def digests(parts: DataFrame, controls: list[str] | None = None) -> DataFrame:
    """One row per conversation, read back from the parts as format_conversations left them.

    Turns are found and unescaped in the text; the loss text is what the spans cut out of it.
    """
    controls = controls or CONTROLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unescape = escaper(controls)[1]

        def read() -> Iterator[tuple]:
            for conv, rows in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                turns, loss, sizes = hashlib.sha256(), hashlib.sha256(), {"turns": 0, "loss": 0, "all": 0}

                def texts() -> Iterator[str]:
                    for _, _, text, spans in rows:
                        for span in spans:
                            said = unescape(text[span["start"] - sizes["all"] : span["end"] - sizes["all"]])
                            loss.update(said.encode())
                            sizes["loss"] += len(said)
                        sizes["all"] += len(text)
                        yield text

                for role, text in read_turns(texts(), unescape):
                    turns.update(f"{role}\n{text}\n".encode())
                    sizes["turns"] += 1
                yield conv, sizes["turns"], turns.hexdigest(), sizes["loss"], loss.hexdigest(), sizes["all"]

        yield from _batches(read(), _DIGEST)

    return parts.select("conv_id", "part", "text", "loss").mapInArrow(run, DIGEST)
