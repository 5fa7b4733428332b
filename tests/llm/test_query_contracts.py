"""Registered queries that SQL cannot express: columns, types, what they learn from, and plain versions of the rest."""

import hashlib
import pathlib
import re
import zlib
from array import array

import pyarrow as pa
import pyarrow.parquet as pq

from conftest import DATA
from tokenizers import Tokenizer

from tierhouse.llm import queries
from tierhouse.llm.queries import URL_RULES, tokenizer_path
from tierhouse.llm.registry import QUERIES

SF = str(DATA / "sf0.001")


def crc(value):
    return zlib.crc32(str(value).encode())


def rows_of(name, folder=SF):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def altered(tmp_path, name, change):
    """The folder with one table changed row by row."""
    folder = tmp_path / "altered"
    folder.mkdir()
    for file in pathlib.Path(SF).iterdir():
        if file.name != f"{name}.parquet":
            (folder / file.name).symlink_to(file)
    table = pq.read_table(f"{SF}/{name}.parquet")
    pq.write_table(pa.Table.from_pylist([change(dict(r)) for r in table.to_pylist()], schema=table.schema), folder / f"{name}.parquet")
    return str(folder)


def types(df):
    return dict(df.dtypes)


def test_toxicity(spark, tmp_path):
    got = QUERIES["op2_toxicity"](spark, SF)
    assert types(got).items() >= {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}.items()
    rows = {r.doc_id: r for r in got.collect()}
    docs = rows_of("documents")
    assert sorted(rows) == sorted(d["doc_id"] for d in docs)
    for key, r in rows.items():
        assert r.held_out == (crc(key) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    toxic = {r["doc_id"]: r["toxic"] for r in rows_of("labels")}
    held = [(rows[k].predicted, v) for k, v in toxic.items() if rows[k].held_out]
    assert sum(p == t for p, t in held) >= 0.9 * len(held) > 0

    def flipped(row):
        return row | {"toxic": 1 - row["toxic"]} if crc(row["doc_id"]) % 4 == 2 else row

    again = QUERIES["op2_toxicity"](spark, altered(tmp_path, "labels", flipped)).collect()
    assert {r.doc_id: r.score for r in again} == {k: r.score for k, r in rows.items()}


def test_language(spark, tmp_path):
    got = QUERIES["op4_language_id"](spark, SF)
    assert types(got).items() >= {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}.items()
    rows = {r.doc_id: r for r in got.collect()}
    docs = {d["doc_id"]: d for d in rows_of("documents")}
    assert rows.keys() == docs.keys()
    learned = {d["lang"] for k, d in docs.items() if d["lang"] and crc(k) % 5}
    for key, r in rows.items():
        assert r.held_out == (crc(key) % 5 == 0) and 0 <= r.score <= 1 and r.lang_pred in learned | {"und"}
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in docs[key]["text"] or ""))
    held = [k for k, r in rows.items() if r.held_out]
    assert sum(rows[k].lang_pred == docs[k]["lang"] for k in held) >= 0.95 * len(held) > 0

    def swapped(row):
        return row | {"source": "none", "n_chars": 0} | ({"lang": "en"} if crc(row["doc_id"]) % 5 == 0 else {})

    again = QUERIES["op4_language_id"](spark, altered(tmp_path, "documents", swapped)).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in again} == {k: (r.lang_pred, r.score) for k, r in rows.items()}


def test_tokens(spark):
    got = QUERIES["op5_bpe"](spark, SF)
    assert types(got).items() >= {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}.items()
    library = Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    rows = {r.doc_id: r for r in got.collect()}
    for d in rows_of("documents"):
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        r = rows.pop(d["doc_id"])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert not rows


def test_shards(spark):
    got = QUERIES["op6_sharding"](spark, SF)
    assert types(got) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int",
                          "slot": "bigint", "grown_shard": "int"}
    rows = got.collect()
    docs = {d["doc_id"]: (d["text"] or "").encode() for d in rows_of("documents")}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    slots = {}
    for r in rows:
        assert (r.size, r.text_crc32) == (len(docs[r.doc_id]) + 1, zlib.crc32(docs[r.doc_id]))
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 16
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(slots) == 16 and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_urls(spark):
    got = QUERIES["op9_url_filter"](spark, SF)
    assert types(got).items() >= {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"}.items()
    rows = {r.page_id: r for r in got.collect()}
    for page in rows_of("pages"):
        r = rows.pop(page["page_id"])
        host = path = ""
        if page["url"] and "://" in page["url"]:
            host, path = re.match(r"[^/?#]*", rest := page["url"].split("://", 1)[1])[0], ""
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h) + len(p), v, h + p) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (host, path)
        assert r.rule == (max(fits)[2] if fits else None)
        assert r.verdict == max(fits)[1] if fits else r.verdict in ("allow", "block")
    assert not rows


def test_every_query_is_registered():
    names = [n for n in QUERIES if n.startswith("op")]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert queries.SHARDS == 16


