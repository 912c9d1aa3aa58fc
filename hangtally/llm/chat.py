"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only its text is under the
loss mask. Turns are written as ``<|im_start|>role\\ntext<|im_end|>\\n``; in roles and texts a backslash
becomes two and ``<|`` becomes ``<\\|``, so a text cannot end its turn, and reading undoes it.

An example's context is the conversation so far, which may be long. Its text column holds the context from character
``start`` on; what lies before stands in ``context`` rows of ``BLOCK`` characters or more, which come earlier in
the conversation (smaller ``seq``) and are shared by all later examples. So a conversation of any number of turns
costs memory for one block and turn, and its output does not grow with the square of its length. Most
conversations are shorter than a block: their examples hold all their context. Turns after the last
assistant turn form a ``rest`` row, which has no target.

Cases: a null text is empty, a null role is an empty role. Turns stand in the order of turn, then role, then
text, nulls first, so repeated turns have a fixed order. A null conv_id is a conversation of its own.
A conversation without assistant has only a rest row and no loss. An empty table gives an empty result.
``whole_examples`` reads examples with all their context. A conversation is worked on in one task, turn by turn, so one with very many
turns takes long there but not more memory. Further columns of any name are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from hangtally.llm.common import batch, prepare, rows_of, stored

BEGIN, END, BLOCK = "<|im_start|>", "<|im_end|>", 32_768
#: kind: example, context or rest; text covers the conversation from start on, the mask is text[loss_from:loss_to].
EXAMPLES = "conv_id bigint, seq bigint, kind string, start bigint, text string, loss_from bigint, loss_to bigint"
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escaped_role(role: str) -> str:
    return escaped(role).replace("\n", "\\n")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


def expanded(turns: DataFrame) -> DataFrame:
    """Rows of ``EXAMPLES`` for turns (conv_id, turn, role, text)."""
    prepare(turns.sparkSession)
    schema = to_arrow_schema(_parse_datatype_string(EXAMPLES))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        size, seq, start, held, length, ended = 0, 0, 0, [], 0, 0
        now, begun = None, False

        def rest():
            nonlocal seq
            if begun and start + length > ended:
                text = "".join(held)
                made.append((now, seq, "rest", start, text, len(text), len(text)))
                seq += 1

        for conv, role, text in rows_of(batches):
            if not begun or conv != now:
                rest()
                now, begun = conv, True
                seq, start, held, length, ended = 0, 0, [], 0, 0
            head, body = f"{BEGIN}{escaped_role(role or '')}\n", escaped(text or "")
            if length >= BLOCK:   # what is held so far becomes shared context
                made.append((now, seq, "context", start, "".join(held), length, length))
                size += length
                seq, start, held, length = seq + 1, start + length, [], 0
            held.append(head + body + END + "\n")
            if role == "assistant":
                whole = "".join(held)
                held = [whole]
                made.append((now, seq, "example", start, whole, length + len(head), length + len(head) + len(body)))
                size += len(whole)
                seq, ended = seq + 1, start + len(whole)
            length += len(held[-1]) if role != "assistant" else len(whole) - length
            if size >= 4 << 20:
                yield batch(schema, *zip(*made))
                made, size = [], 0
        rest()
        if made:
            yield batch(schema, *zip(*made))

    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return dealt.mapInArrow(work, EXAMPLES)


def whole_examples(examples: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Rows (conv_id, seq, context, target) of all examples, or of those of ``wanted`` (conv_id, seq): the shared
    context rows before an example and its own text up to the mask, joined to one, and the text under the mask."""
    chosen = examples.where("kind = 'example'")
    if wanted is not None:
        same = chosen["conv_id"].eqNullSafe(wanted["conv_id"]) & (chosen["seq"] == wanted["seq"])
        chosen = chosen.join(wanted.select("conv_id", "seq"), same, "left_semi")
    shared = examples.where("kind = 'context'").select(F.col("conv_id").alias("_conv"), F.col("start").alias("_start"), F.col("text").alias("_text"))
    met = chosen.join(shared, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_start") < F.col("start")), "left")
    before = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_conv").isNotNull() | F.col("_start").isNotNull(), F.struct("_start", "_text")))), lambda x: x["_text"]), "")
    rows = met.groupBy("conv_id", "seq", "text", "loss_from", "loss_to").agg(before.alias("before"))
    return rows.select("conv_id", "seq", F.concat("before", F.expr("substr(text, 1, loss_from)")).alias("context"),
                       F.expr("substr(text, loss_from + 1, loss_to - loss_from)").alias("target"))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from its examples: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    formatted_chars is the length of the conversation as formatted, each turn once.
    """
    prepare(examples.sparkSession)
    out = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    schema = to_arrow_schema(_parse_datatype_string(out))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        now, begun = None, False
        n = chars = upto = 0
        turns = loss = None

        def done():
            if begun:
                made.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), upto))

        for conv, kind, start, text, low, high in rows_of(batches):
            if not begun or conv != now:
                done()
                now, begun, n, chars, upto = conv, True, 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            fresh = text[upto - start:]   # rows end with whole turns, so what is new begins with one
            at = 0
            for m in _TURN.finditer(fresh):
                if m.start() != at:
                    raise ValueError(f"conversation {conv} is not well formed")
                at = m.end()
                n += 1
                turns.update(f"{unescaped(m[1])}\n{unescaped(m[2])}\n".encode("utf-8", "surrogatepass"))
            if at != len(fresh):
                raise ValueError(f"conversation {conv} is not well formed")
            upto = start + len(text)
            if kind == "example":
                target = unescaped(text[low:high])
                chars += len(target)
                loss.update(target.encode("utf-8", "surrogatepass"))
            if len(made) >= 10_000:
                yield batch(schema, *zip(*made))
                made = []
        done()
        if made:
            yield batch(schema, *zip(*made))

    parts = int(examples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = examples.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "seq")
    return dealt.select("conv_id", "kind", "start", "text", "loss_from", "loss_to").mapInArrow(work, out)


def report(turns: DataFrame) -> DataFrame:
    return read_back(stored(expanded(turns), "chat-examples"))
