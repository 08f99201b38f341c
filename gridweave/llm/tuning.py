"""How the settings of the two classifiers were picked: on a fold inside the rows that may be learned from.

``python -m gridweave.llm.tuning toxic|quality FOLDER [MOST]`` fits every candidate on the rows whose crc32(doc_id) mod 5 is 1,
2 or 3 and scores it on the rows where it is 4. Rows where it is 0, the held-out fold, are never read. MOST bounds the
training rows, by the same hash order as in production.
"""

from __future__ import annotations

import sys
import zlib
from concurrent.futures import ProcessPoolExecutor
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash

from gridweave.llm import quality, toxicity
from gridweave.llm.labelled import FOLDS
from gridweave.llm.textblock import utf8

VALIDATION = FOLDS - 1
#: Settings by module constant; the first of each list is what the module has.
CANDIDATES = {
    "toxic": [
        {}, {"L1": 6.0}, {"L1": 20.0}, {"ALPHA": 1.0}, {"ALPHA": 6.0}, {"MIN_ROWS": 3}, {"MIN_ROWS": 10}, {"EPOCHS": 5}, {"EPOCHS": 15}, {"HASH_BITS": 21}, {"SKIPS": (1,)},
    ],
    "quality": [{}, {"EPOCHS": 4}, {"EPOCHS": 12}, {"RATE": 0.01}, {"RATE": 0.04}, {"BATCH": 64}],
}


def rows_of(folder: str, target: str) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]]:
    """(training, validation) rows (text, label), the training rows in hash order of their ids."""
    labels = pq.read_table(Path(folder) / "labels.parquet", columns=["doc_id", target]).to_pydict()
    wanted = {d: y for d, y in zip(labels["doc_id"], labels[target], strict=True) if d is not None and y is not None and zlib.crc32(str(d).encode()) % FOLDS}
    train, held = [], []
    for batch in pq.ParquetDataset(Path(folder) / "documents.parquet").read(columns=["doc_id", "text"]).to_batches():
        for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if d in wanted and text is not None:
                own = held if zlib.crc32(str(d).encode()) % FOLDS == VALIDATION else train
                own.append((xxhash.xxh64_intdigest(d.to_bytes(8, "little", signed=True), 42), text.encode(), wanted[d]))
    return [r[1:] for r in sorted(train)], [r[1:] for r in held]


def _toxic_rows(rows: list[tuple[bytes, int]]) -> list[tuple[np.ndarray, int]]:
    out = []
    for text, label in rows:
        _, index = toxicity.distinct(*toxicity.features(*utf8(pa.array([text.decode()]))))
        out.append((index, label))
    return out


def scored(target: str, settings: dict, folder: str, most: int) -> tuple[dict, float, float, float]:
    """(settings, accuracy, recall of label 1, share of label 0 called 1) on the validation rows."""
    module = toxicity if target == "toxic" else quality
    for name, value in settings.items():
        setattr(module, name, value)
    train, held = rows_of(folder, target)
    train = train[:most]
    if target == "toxic":
        weights, bias = toxicity.fit(_toxic_rows(train))
        scores = [1 / (1 + np.exp(-np.clip(weights[i].sum() + bias, -30, 30))) for i, _ in _toxic_rows(held)]
    else:
        model = quality.fit(train)
        tables = model.pairs()
        scores = [quality.score_text(t, model, tables) for t, _ in held]
    said, true = np.array(scores) >= module.THRESHOLD, np.array([y for _, y in held], bool)
    return settings, float((said == true).mean()), float(said[true].mean()), float(said[~true].mean())


def main(target: str, folder: str, most: str | None = None) -> None:
    bound = int(most or (toxicity if target == "toxic" else quality).TRAIN_ROWS)
    with ProcessPoolExecutor(6) as pool:
        for job in [pool.submit(scored, target, s, folder, bound) for s in CANDIDATES[target]]:
            settings, accuracy, recall, alarms = job.result()
            print(f"{settings or 'as in the module'}: accuracy {accuracy:.4f}, label 1 found {recall:.4f}, label 0 called 1 {alarms:.4f}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
