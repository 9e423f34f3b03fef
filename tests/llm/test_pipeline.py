"""Every stage of the pipeline on its own input against a plain version, and run() against the stages in turn."""

import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from quillmap.llm import mixing
from quillmap.llm.fast_tokens import load

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
MAIL = "write to ann.86@mail8.example.com today"


def _rows():
    rng = random.Random(11)
    vocabulary = [f"word{i}" for i in range(500)]
    rows, toxic = [], []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            words[10:10] = ["awful", "scum"]
        rows.append((i, " ".join(words) + (f" {MAIL}" if i % 10 == 1 else "")))
        toxic.append((i, int(bad)))
    clean = [r for r in rows if r[0] % 4]
    rows += [(1000 + k, clean[k][1]) for k in range(20)]  # exact copies
    rows += [(1100 + k, re.sub(r"^\S+", "changed", clean[k + 30][1])) for k in range(20)]  # near copies
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, " ".join(rng.choice(vocabulary) for _ in range(9000)))]
    sources = ["a", "a", "a", "b", "c", None]
    docs = [(i, t, "en", sources[i % 6], None if t is None else len(t)) for i, t in rows]
    return docs, toxic


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory):
    docs, toxic = _rows()
    d = tmp_path_factory.mktemp("sf")
    frame = pd.DataFrame(docs, columns=COLUMNS)
    frame["n_chars"] = frame["n_chars"].astype("Int64")
    frame.to_parquet(d / "documents.parquet")
    pd.DataFrame([(i, 1, t) for i, t in toxic], columns=["doc_id", "quality", "toxic"]).to_parquet(d / "labels.parquet")
    return str(d)


def _apply(spark, name, rows, sf_dir):
    stage = dict(corpus_pipeline.STAGES)[name]
    return [tuple(r) for r in stage(spark, spark.createDataFrame(rows, SCHEMA), sf_dir).collect()]


def _plain_near(rows):
    """The rows that stay: of each component of links the least id."""
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                root[b] = a
    return {r[0] for i, r in enumerate(rows) if find(i) == i}


def test_stages_against_plain_versions(spark, sf_dir):
    docs, toxic = _rows()
    # toxicity: what is planted goes, everything else stays as it is
    bad = {i for i, t in toxic if t}
    kept = _apply(spark, "toxicity", docs, sf_dir)
    assert sorted(kept, key=lambda r: r[0]) == sorted((r for r in docs if r[0] not in bad), key=lambda r: r[0])
    # near duplicates
    single = _apply(spark, "near_duplicates", kept, sf_dir)
    assert {r[0] for r in single} == _plain_near(kept) and len(single) == len(kept) - 40
    assert set(single) <= set(kept)
    # personal data: only the address changes, and to the same one everywhere
    clear = {r[0]: r for r in _apply(spark, "pii", single, sf_dir)}
    assert len(clear) == len(single)
    drawn = set()
    for r in single:
        own = clear[r[0]]
        assert own[2:4] == r[2:4] and own[4] == (r[4] if own[1] is None else len(own[1]))
        if r[1] and MAIL in r[1]:
            head, tail = own[1].split("write to ")
            assert head == r[1].split("write to ")[0] and "ann.86" not in tail and tail.endswith(" today")
            drawn.add(tail)
        else:
            assert own[1] == r[1]
    assert len(drawn) == 1
    # mixing: as many rows of each document as its share of words says
    documents = pd.DataFrame(list(clear.values()), columns=COLUMNS)  # noqa: F841
    plan = duckdb.sql(mixing.SQL).df().set_index("doc_id")
    mixed = _apply(spark, "mixing", list(clear.values()), sf_dir)
    copies = pd.Series([r[0] for r in mixed]).value_counts()
    for i, p in plan[plan["size"] > 0].iterrows():
        assert copies.get(i, 0) == p["taken"] // p["size"]
    assert set(mixed) <= set(clear.values())
    # packing: each piece's ids as the library gives them, sequences without gaps
    pieces = _apply(spark, "packing", mixed, sf_dir)
    assert sorted(p[:5] for p in pieces) == sorted(_plain_pieces(mixed))
    _sequences(pieces)
    # run() is the stages in turn
    ran = [tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()]
    assert sorted(r[:5] for r in ran) == sorted(p[:5] for p in pieces)
    _sequences(ran)


def _plain_pieces(rows):
    library = load("word_bpe_49k.json").library
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for k, lo in enumerate(range(0, len(ids), 4096)):
            part = ids[lo : lo + 4096]
            yield r[0], k, lo, len(part), zlib.crc32(np.array(part, "<u4").tobytes())


def _sequences(pieces):
    frame = pd.DataFrame(pieces, columns=["doc_id", "piece", "start", "length", "crc", "sequence", "offset"]).sort_values(["sequence", "offset"])
    assert (frame.groupby("sequence")["length"].cumsum() - frame["length"] == frame["offset"]).all()
    filled = frame.groupby("sequence")["length"].sum()
    assert filled.max() <= 4096 and len(filled) <= -(-frame["length"].sum() // 4096) + 1


def test_pipeline_of_empty_tables(spark, tmp_path):
    pd.DataFrame(columns=COLUMNS).astype({"doc_id": "int64", "text": "str", "lang": "str", "source": "str", "n_chars": "int64"}).to_parquet(tmp_path / "documents.parquet")
    pd.DataFrame({"doc_id": [1], "quality": [1], "toxic": [0]}).to_parquet(tmp_path / "labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
