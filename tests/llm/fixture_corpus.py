"""A small corpus with planted cases, written as the tables that the queries read."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

SYLLABLES = ["an", "the", "or", "ti", "ble", "re", "st", "ou", "ed", "ing", "wa", "ko", "mi", "lu"]
INSULTS = ["grumbo", "snarfel", "blortish"]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def prose(rng: random.Random, n: int, per_line: int = 14) -> str:
    found = words(rng, n)
    return "\n".join(" ".join(found[i : i + per_line]) for i in range(0, n, per_line))


def edited(rng: random.Random, text: str, changes: int) -> str:
    parts = text.split(" ")
    for at in rng.sample(range(len(parts)), changes):
        parts[at] = "changed" + str(rng.randint(0, 99))
    return " ".join(parts)


def documents(seed: int = 5) -> list[dict]:
    rng = random.Random(seed)
    texts: list[str | None] = [prose(rng, rng.randint(3, 400)) for _ in range(120)]
    original = prose(rng, 300)
    texts += [original] * 6  # exact copies
    texts += [edited(rng, original, 3) for _ in range(6)]  # near copies
    passage = " ".join(words(rng, 70))
    texts += [f"{prose(rng, 60)}\n{passage}\n{prose(rng, 50)}" for _ in range(5)]
    for i in range(8):  # a log line with a variable name, one with a number
        name = words(rng, 1)[0] + str(i)
        plain = "".join(rng.choices(SYLLABLES, k=6))
        texts.append(
            f"{prose(rng, 40)}\nposted on this board by user {name} at night\n"
            f"all of the rights in this page belong to {plain} for ever\n{prose(rng, 40)}"
        )
    for i in range(30):
        body = words(rng, rng.randint(20, 200))
        body.insert(len(body) // 2, INSULTS[i % 3])
        texts.append(" ".join(body))
    texts += [None, "", " \n\t ", "one", "one", "two words", "naïve élan 日本語のテキスト", "x" * 5000]
    texts.append(prose(rng, 9000))  # a long text
    toxic = [text is not None and any(w in text.split() for w in INSULTS) for text in texts]
    sources = ["b", "a", None, "é", "a", "a"]
    return [
        {
            "doc_id": 3 * i + (i % 2),
            "text": text,
            "lang": "en",
            "source": sources[i % len(sources)],
            "n_chars": len(text or ""),
            "toxic": int(toxic[i]),
        }
        for i, text in enumerate(texts)
    ]


def embeddings(seed: int = 6) -> list[dict]:
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(120)]
    near = [[x + rng.gauss(0, 0.2) for x in base[i % 10]] for i in range(60)]
    vectors: list = base + near + [base[3]] * 5 + [[2 * x for x in base[4]]]
    vectors += [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] * 64, [None] * 64]
    labels = [i % 3 if i % 11 else None for i in range(len(vectors))]
    for i in range(120, len(vectors)):
        labels[i] = labels[(i - 120) % 10] if i < 180 else labels[3]
    return [{"vec_id": 2 * i, "embedding": v, "label": label} for i, (v, label) in enumerate(zip(vectors, labels))]


def write(folder: Path) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    rows = documents()
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
    pq.write_table(pa.Table.from_pylist([{k: r[k] for k in schema.names} for r in rows], schema), folder / "documents.parquet")
    labels = pa.table({
        "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()),
        "quality": pa.array([1] * len(rows), pa.int32()),
        "toxic": pa.array([r["toxic"] for r in rows], pa.int32()),
    })
    pq.write_table(labels, folder / "labels.parquet")
    kinds = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])
    pq.write_table(pa.Table.from_pylist(embeddings(), kinds), folder / "embeddings.parquet")
    return str(folder)
