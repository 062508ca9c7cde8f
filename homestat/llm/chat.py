"""Chat formatting: conversations through a compiled template, with generation markers."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.llm.common import table
from homestat.llm.template import Writer, compile_template, unescape

TEMPLATE = (
    "{% for m in messages %}<turn {{ m.role | name }}>\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}")
PIECES = "conv_id long, piece long, text string, loss array<struct<first:long,end:long>>"
LOSS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, piece, text, loss): the formatted conversations, one piece a message, in order.

    A conversation's output is its pieces, joined; ``loss`` holds the generation spans in code
    points of the whole output. Messages go by turn (nulls first), then role and text; repeated
    rows are messages of their own. Null roles and texts count as empty; rows without conv_id
    make one conversation without an id. Partitions are sorted and rendered as a stream, so a
    conversation of any length takes the memory of one batch. An empty table gives no rows.
    """
    compile_template(template)  # a bad template fails here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = compile_template(template)
        waiting, made, at, index = None, [], 0, 0

        def render(conv, role, text, last):
            nonlocal at, index
            out = Writer(at)
            env = {"message": {"role": role or "", "text": text or ""}, "loop": {"first": not index, "last": last, "index0": index}}
            if not index:
                compiled.head(env, out)
            compiled.turn(env, out)
            if last:
                compiled.tail(env, out)
            made.append((conv, index, "".join(out.parts), [{"first": a, "end": b} for a, b in out.spans]))
            at, index = (0, 0) if last else (out.at, index + 1)

        def flush():
            columns = list(zip(*made)) or [[], [], [], []]
            made.clear()
            kinds = (pa.int64(), pa.int64(), pa.string(), LOSS)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "piece", "text", "loss"])

        for batch in batches:
            for row in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                if waiting:
                    render(*waiting, last=row[0] != waiting[0])
                waiting = row
            yield flush()
        if waiting:
            render(*waiting, last=True)
            yield flush()

    named = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text"))
    placed = named.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.select("conv_id", "role", "text").mapInArrow(run, PIECES)


STEP = re.compile(r"\\.|</turn>\n", re.DOTALL)
HEAD = re.compile(r"<turn ((?:[^\\>]|\\.)*)>\n", re.DOTALL)


class Reader:
    """Reads formatted output back, piece by piece: turns, and the text under the loss mask."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss_chars, self.chars, self.rest = conv, 0, 0, 0, ""
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, spans: list[dict]) -> None:
        for s in spans:
            answer = unescape(text[s["first"] - self.chars:s["end"] - self.chars])
            self.loss_chars += len(answer)
            self.loss.update(answer.encode())
        self.chars += len(text)
        self.rest += text
        while head := HEAD.match(self.rest):
            end = next((m for m in STEP.finditer(self.rest, head.end()) if m[0][0] != "\\"), None)
            if end is None:
                return
            body = unescape(self.rest[head.end():end.start()])
            self.all.update(f"{unescape(head[1])}\n{body}\n".encode())
            self.turns += 1
            self.rest = self.rest[end.end():]

    def row(self) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {self.conv}: output after its last turn")
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """One row of digests per conversation, from the formatted pieces in their partitions' order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, done = None, []
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = [x.split()[0] for x in DIGESTS.split(", ")]

        def flush():
            columns = list(zip(*done)) or [[]] * len(kinds)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for conv, piece, text, spans in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if not piece:
                    if reader:
                        done.append(reader.row())
                    reader = Reader(conv)
                reader.read(text, spans)
            yield flush()
        if reader:
            done.append(reader.row())
            yield flush()

    return pieces.mapInArrow(run, DIGESTS)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    tricky = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(rows.unionByName(own)))
