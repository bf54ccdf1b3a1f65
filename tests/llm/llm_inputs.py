"""A small table of documents with everything that may go wrong."""

from __future__ import annotations

import random

# Names that the operators use inside or for their results.
EXTRA = ["_size", "_score", "_bytes", "_id", "_text", "_copies", "n", "size", "piece"]
SHARED = "\n".join(" ".join(f"shared{k}x{j}" for j in range(30)) for k in range(2))


def texts() -> list[tuple[int | None, str | None, str | None]]:
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    copy = prose(60)
    near = copy.split()
    near[30] = "other"
    return [
        (0, None, "a"), (1, "", "a"), (2, " \t\n \n", "b"), (3, "word", None),
        (4, f"{prose(20)}\n{SHARED}\n{prose(10)}", "b"), (5, f"own words {prose(20)}\n{SHARED}", "é"),
        (6, prose(9000), "b"), (7, "x" * 70_000, "B"), (8, prose(80), "b"), (8, "same id, other text", "b"),
        (10, copy, "b"), (11, copy, "b"), (12, " ".join(near), None), (12, " ".join(near), None),
        (None, prose(30), "b"), (14, "<|endoftext|>don't 'll  \r\n İ 中文́", "b"),
    ]


def documents(spark):
    rows = [(*r, k, *[k] * len(EXTRA)) for k, r in enumerate(texts())]
    # Rows 8 and 9 share an id; make them alike.
    rows[9] = (*rows[8][:3], 9, *[9] * len(EXTRA))
    names = ", ".join(f"{c} int" for c in EXTRA)
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, row int, {names}")
