import random

import pytest

CLASHES = ["_k", "_t", "_row", "n", "row", "key", "block", "name", "part", "words", "label", "component", "rank", "length"]


def passages(seed=3):
    """Texts with copies, near copies, shared passages, odd white space, and very short and long ones."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(400)]
    shared = " ".join(r.choice(vocabulary) for _ in range(45))
    texts = [None, "", " ", "\n\n", "x", "x", "X", "é", "one two", "One two", "a b c", "a B c"]
    for i in range(24):
        lines = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 40))) for _ in range(r.randint(1, 6))]
        if i % 3 == 0:
            lines.insert(len(lines) // 2, shared)
        texts.append("\n".join(lines))
    texts.append(texts[12])
    texts.append(texts[13] + " extra")
    texts.append(texts[14].replace("a", "e", 1))
    texts.append("of " * 70)
    texts.append("tab\tand\rreturn  and\x0bmore\x0c " + shared)
    texts.append(" ".join(r.choice(vocabulary) for _ in range(6000)) + " " + shared)
    texts.append("w" * 50_000)
    return texts


@pytest.fixture(scope="session")
def documents(spark):
    """A messy table: null and repeated ids, repeated rows, extra columns with clashing names."""
    rows = [(i * 3 % 101, t) for i, t in enumerate(passages())]
    rows += [rows[12], (rows[13][0], "another text under the same id " + rows[14][1])]
    rows += [(None, rows[15][1]), (None, "a null id only"), (None, None)]
    extra = [f"extra {i}" for i in range(len(CLASHES))]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(i, t, "en", *extra) for i, t in rows], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def plain(documents):
    """Documents as (id, text), one for each id and text, with ids and texts that can be compared."""
    return sorted({(-1 if r.doc_id is None else r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()}, key=str)
