"""Splitting oversized items at natural boundaries (problem 2).

Method: dynamic programming over boundary positions. The candidates of a text are
its line ends, rated by what ends there (a top-level block, a blank line, a statement
line, a deeper line); where two candidates are further apart than a piece may be,
token ends and, failing those, bare positions are added in between. The programme
minimises the sum of cut penalties and of squared deviations of the pieces'
lengths from an equal division, subject to the maximum length and to consecutive
pieces sharing exactly ``overlap`` characters.

Cases: null and short texts give no row; a row delivered twice counts once; a text
with no line feed is cut at token ends; an empty table gives an empty result;
further columns are ignored. Pieces always cover the whole text in order.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most characters in a piece, and characters that consecutive pieces share.
MOST, OVERLAP = 6000, 200

#: Penalties of a cut by what ends there.
BLOCK_END, BLANK_LINE, STATEMENT_END, LINE_END, TOKEN_END, ANYWHERE = 0.0, 0.1, 1.0, 2.0, 6.0, 12.0

_TOKEN_END = re.compile(r"[;,{}()\]\s>]+")


def boundaries(text: str, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a text may be cut and the penalty of each, no two further apart than ``reach`` // 2."""
    at, cost = [], []
    position, top_open = 0, False
    for line in text.splitlines(keepends=True) if "\n" not in text else text.split("\n"):
        body = line.strip()
        position += len(line) + (0 if "\n" not in text else 1)
        if not body:
            price = BLANK_LINE
        elif line[:1] == "}":
            price = BLOCK_END
        elif body[-1] in "}":
            price = STATEMENT_END - 0.2
        elif body[-1] in ";":
            price = STATEMENT_END
        else:
            price = LINE_END
        if position < len(text):
            at.append(position)
            cost.append(price)
    edges = [0, *at, len(text)]
    more_at, more_cost = [], []
    step = max(1, reach // 2)
    for a, b in zip(edges, edges[1:]):
        if b - a <= step:
            continue
        last = a
        for m in _TOKEN_END.finditer(text, a, b):
            if m.end() >= b:
                break
            if m.end() - last > step:  # no token ends here: bare positions
                fill = range(last + step, m.end(), step)
                more_at.extend(fill)
                more_cost.extend([ANYWHERE] * len(fill))
                last = fill[-1] if len(fill) else last
            if m.end() - last >= max(1, step // 40):
                more_at.append(m.end())
                more_cost.append(TOKEN_END)
                last = m.end()
        fill = range(last + step, b, step)
        more_at.extend(fill)
        more_cost.extend([ANYWHERE] * len(fill))
    if more_at:
        at, cost = at + more_at, cost + more_cost
    order = np.argsort(np.array(at, np.int64), kind="stable")
    at, cost = np.array(at, np.int64)[order], np.array(cost, float)[order]
    keep = np.concatenate(([True], at[1:] != at[:-1])) if len(at) else np.zeros(0, bool)
    return at[keep], cost[keep]


def cuts(text: str, most: int = MOST, overlap: int = OVERLAP) -> list[tuple[int, int, float]]:
    """The pieces of a text as (start, end, penalty of the cut at the end)."""
    n = len(text)
    if n <= most:
        return [(0, n, 0.0)] if n else []
    reach = most - overlap
    at, price = boundaries(text, reach)
    ok = (at > overlap) & (at < n)
    at, price = np.append(at[ok], n), np.append(price[ok], 0.0)
    # pieces of nearly equal length: the first has no overlap before it
    number = -(-(n - overlap) // reach)
    target = (n - overlap) / number
    best = np.full(len(at), np.inf)
    back = np.full(len(at), -1, np.int64)
    low = 0
    for j, end in enumerate(at):
        if end <= most:
            best[j] = price[j] + ((end - overlap - target) / target) ** 2 + 1.0
        low += int(np.searchsorted(at[low:j], end - reach))
        if low < j:
            total = best[low:j] + ((end - at[low:j] - target) / target) ** 2
            k = int(np.argmin(total))
            if total[k] + price[j] + 1.0 < best[j]:
                best[j], back[j] = total[k] + price[j] + 1.0, low + k
    ends, j = [], len(at) - 1
    while j >= 0:
        ends.append((int(at[j]), float(price[j])))
        j = int(back[j])
    ends.reverse()
    starts = [0, *(e - overlap for e, _ in ends[:-1])]
    return [(s, e, p) for s, (e, p) in zip(starts, ends)]


_PIECES = "item_kind string, item_id bigint, piece int, start_pos bigint, end_pos bigint, cut string, item_cut string, text string"


def _piece_rows(most: int, overlap: int):
    def run(batches):
        for batch in batches:
            rows = []
            for kind, item, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                whole = "forced" if max(map(len, text.split("\n"))) > most else "natural"
                pieces = cuts(text, most, overlap)
                for k, (start, end, price) in enumerate(pieces):
                    how = "end" if end == len(text) else "natural" if price < TOKEN_END else "forced"
                    rows.append((kind, item, k, start, end, how, whole, text[start:end]))
            columns = list(zip(*rows)) or [[]] * 8
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=[x.split()[0] for x in _PIECES.split(", ")])

    return run


def split_oversized(items: DataFrame, most: int = MOST, overlap: int = OVERLAP) -> DataFrame:
    """The pieces of the items longer than ``most`` characters.

    ``items`` has item_kind string, item_id bigint and text string. Returns item_kind, item_id, piece (from 0),
    start_pos, end_pos, cut (what the piece's end is: natural, forced or end), item_cut (forced if a line
    of the item alone is too long) and the piece's text. Only oversized texts reach Python; rows delivered twice
    come out twice, as they share no key before: deduplicate on (item_kind, item_id, piece).
    """
    if not 0 <= overlap < most // 2:
        raise ValueError("overlap must be less than half of most")
    large = items.where(F.char_length("text") > most).select("item_kind", F.col("item_id").cast("bigint").alias("item_id"), "text")
    return large.mapInArrow(_piece_rows(most, overlap), _PIECES)


def splittable_items(records: DataFrame) -> DataFrame:
    """The items of problem 2: contract files and specs."""
    from vericorpus.sources.tables import contract_files, spec_texts

    files = contract_files(records).select(F.lit("file").alias("item_kind"), F.col("file_id").alias("item_id"), F.col("clean_source").alias("text"))
    specs = spec_texts(records).select(F.lit("spec").alias("item_kind"), F.col("spec_id").alias("item_id"), "text")
    return files.unionByName(specs)
