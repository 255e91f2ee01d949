"""Main text of HTML pages by a linear-chain conditional random field over their leaf blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rollbook.llm.html_blocks import blocks, features
from rollbook.llm.html_pages import labelled_pages

#: Labelled pages the model is trained on.
TRAINING_PAGES = 600
STEPS = 120
RATE = 0.15
DECAY = 1e-4
BETWEEN = "\n\n"


def train(pages: list[str], steps: int = STEPS) -> dict:
    """Weights by maximum likelihood: gradients from forward and backward sums over all pages at once,
    steps by Adam. Blocks inside an element marked ``data-main`` are main text."""
    parsed = [b for b in map(blocks, pages) if b]
    longest = max(map(len, parsed))
    names: dict[str, int] = {}
    row, cell = [], []
    label = np.zeros((len(parsed), longest), np.int64)
    mask = np.zeros((len(parsed), longest), bool)
    for i, page in enumerate(parsed):
        for j, f in enumerate(features(page)):
            mask[i, j] = True
            label[i, j] = page[j].labelled
            row += [names.setdefault(x, len(names)) for x in f]
            cell += [i * longest + j] * len(f)
    row, cell = np.array(row), np.array(cell)
    size, n = label.size, mask.sum()
    gold = np.zeros((size, 2))
    gold[np.arange(size), label.ravel()] = mask.ravel()
    pairs = (mask[:, 1:] & mask[:, :-1]).astype(float)
    steps_gold = np.zeros((2, 2))
    np.add.at(steps_gold, (label[:, :-1].ravel(), label[:, 1:].ravel()), pairs.ravel())
    theta = np.zeros(2 * len(names) + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, step = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        emit = np.stack([np.bincount(cell, w[row, y], size) for y in (0, 1)], axis=1).reshape(*label.shape, 2)
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = emit[:, 0]
        for j in range(1, longest):
            reach = np.logaddexp.reduce(forward[:, j - 1, :, None] + step, axis=1) + emit[:, j]
            forward[:, j] = np.where(mask[:, j, None], reach, forward[:, j - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        for j in range(longest - 2, -1, -1):
            reach = np.logaddexp.reduce(step + (emit[:, j + 1] + backward[:, j + 1])[:, None, :], axis=2)
            backward[:, j] = np.where(mask[:, j + 1, None], reach, 0.0)
        chance = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
        both = forward[:, :-1, :, None] + step + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected = (np.exp(np.minimum(both, 0)) * pairs[:, :, None, None]).sum(axis=(0, 1))
        miss = gold - chance.reshape(size, 2)
        grad_w = np.stack([np.bincount(row, miss[cell, y], len(names)) for y in (0, 1)], axis=1)
        grad = np.append(grad_w.ravel(), (steps_gold - expected).ravel()) / n - DECAY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    w = theta[:-4].reshape(-1, 2)
    return {"weights": {x: float(w[k, 1] - w[k, 0]) for x, k in names.items()}, "step": theta[-4:].reshape(2, 2).tolist()}


def viterbi(scores: list[float], step: list[list[float]]) -> list[int]:
    """Best sequence of labels 0 and 1; ``scores`` are what label 1 has over label 0."""
    if not scores:
        return []
    best, back = [0.0, scores[0]], []
    for s in scores[1:]:
        came = [0 if best[0] + step[0][y] >= best[1] + step[1][y] else 1 for y in (0, 1)]
        best = [best[came[0]] + step[came[0]][0], best[came[1]] + step[came[1]][1] + s]
        back.append(came)
    y = int(best[1] > best[0])
    out = [y]
    for came in reversed(back):
        y = came[y]
        out.append(y)
    return out[::-1]


def main_text(html: str | None, model: dict) -> str:
    page = blocks(html)
    weights = model["weights"]
    scores = [sum(weights.get(x, 0.0) for x in f) for f in features(page)]
    return BETWEEN.join(b.text for b, y in zip(page, viterbi(scores, model["step"]), strict=True) if y)


def extract(pages: DataFrame, model: dict | None = None, html_column: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``: the main text of the whole page.

    Main blocks are joined in page order by an empty line; nothing in them is dropped or cut. Null, empty
    and text-free pages have an empty text; plain text without markup is a block like others. Columns
    ``text`` and ``n_chars`` are replaced. Without ``model`` one is trained on labelled pages made by rule.
    """
    model = model or train(labelled_pages(TRAINING_PAGES))
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in pages.columns if c.lower() not in ("text", "n_chars")]
    carried = [c for c in kept if c != html_column]

    def run(batches):
        for batch in batches:
            texts = [main_text(h, shared.value) for h in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*carried, "text", "n_chars"],
            )

    schema = StructType([*[pages.schema[c] for c in carried], StructField("text", StringType()), StructField("n_chars", LongType())])
    return pages.select(F.col(html_column), *carried).mapInArrow(run, schema)
