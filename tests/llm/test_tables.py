"""Mixing, search, archives, outliers, chat, classifier, pipeline."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_near_dup import plain as plain_components
from test_text_scans import plain_spans
from tokenizers import Tokenizer

import corpus_pipeline
from tatemono.llm import chat, mixing, outliers, packing, quality_mil, sql, topk, warc
from tatemono.llm.passages import FEATURES, encode
from tatemono.llm.queries import QUERIES
from tatemono.sources import scratch

SF = "/root/testdata/sf0.001"


def reference(statement, **tables):
    con = duckdb.connect()
    for name, table in tables.items():
        con.register(name, table)
    cursor = con.execute(statement)
    columns = [d[0] for d in cursor.description]
    return sorted((tuple(dict(zip(columns, r, strict=True))[c] for c in sorted(columns)) for r in cursor.fetchall()), key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


# mixing


def mix_rows(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        source = rng.choice(["hot"] * 6 + ["a", "b", "c", "é", "Z", None])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 10, 300])), source))
    rows += [(1000, None, "a"), (None, "x y z", "b"), (5, "only here", "tiny"), (2000, "w " * 5000, "a")] + [(7, "same text", "b")] * 9
    return rows


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_mix_against_sql(spark, seed):
    rows = mix_rows(seed)
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, source string, size int, target double")
    got = mixing.mix(docs)
    table = pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate([("doc_id", pa.int64()), ("text", pa.string()), ("source", pa.string())])})
    assert rows_of(got) == reference(sql.MIX, documents=table)
    assert rows_of(got) == rows_of(mixing.mix(docs.repartition(5)))


def test_mix_is_near_its_targets_and_whole(spark):
    """The cut comes after every source has reached its target but for the
    document it is at."""
    rows = mix_rows(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    parts = mixing.mix(docs).collect()
    assert sum(r["taken"] for r in parts) <= sum(r["size"] for r in parts)
    assert all(r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0) for r in parts)
    sources = {}
    for r in parts:
        sources.setdefault((r["target"], r["source_size"]), []).append(r)
    for (target, _), members in sources.items():
        assert sum(r["taken"] for r in members) >= target - max(r["size"] for r in members)


def test_mix_without_words_and_without_rows(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix(docs).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix_documents(docs).count() == 0


def test_mixed_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(i, "w " * (i + 1), "ab"[i % 2], 1.5) for i in range(20)], "doc_id long, text string, source string, _mix_row double")
    want = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(docs).collect() if r["taken"]}
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == want
    assert {r["_mix_row"] for r in out.collect()} == {1.5}


# search


def test_top_k_against_brute_force(spark):
    rng = random.Random(2)
    vectors = {i: [rng.choice([0.0, rng.uniform(-1, 1), 0.25]) for _ in range(6)] for i in range(300)}
    vectors |= {i: vectors[3] for i in range(40, 90)}
    rows = [(i, v, "x") for i, v in vectors.items()] + [(0, vectors[0], "again"), (None, [1.0] * 6, ""), (100, [5.0] * 6, "larger")]
    rows += [(400, None, ""), (401, [1.0, None], ""), (402, [float("nan")], ""), (403, [float("inf")], ""), (500, [], ""), (501, [9.0], "")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    rows += [(41, [9.0] * 6, "another vector of an id"), (200, [-9.0] * 6, "a query too")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    usable = [(i, v) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in usable]
    want = []
    for place, (q, w) in enumerate(whole):
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(w, v, strict=False)), i) for other, (i, v) in enumerate(whole) if other != place)
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:10])]
    for options in ({}, {"candidates": 37, "queries": 2}):
        assert sorted(tuple(r) for r in topk.top_k(table, **options).collect()) == sorted(want)
    assert topk.top_k(table.limit(0)).count() == 0
    assert topk.top_k(table.where("vec_id = 500")).count() == 0


# archives


def plain_archive(rows):
    want = []
    for page_id, html in rows:
        data = (html or "").encode()
        same = [p for p, h in rows if (h or "") == (html or "") and p is not None]
        original = max(same, default=None)
        revisit = original is not None and page_id != original
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((page_id, len(data), digest, "revisit" if revisit else "response", original if revisit else None))
    return sorted(want, key=repr)


def archive_rows():
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    texts = ["<p>é</p>", "", None, fake, "x" + fake * 3, "WARC/1.1\r\n", "WARC/1.1\r\n" * 50, "\r\n\r\n", "a\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"]
    texts += ["long " * 100_000, fake + "y" * 300_000 + fake] + [f"page {i}" for i in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(200 + i, t) for i, t in enumerate(texts[:8])]
    return rows + [(None, "page 1"), (None, "nobody"), (7, texts[7]), (207, texts[7])]


@pytest.mark.parametrize("split", ["64k", "64m"])
def test_archives_round_trip(spark, split):
    rows = archive_rows()
    pages = spark.createDataFrame([(p, "http://a/\r\nX: 1" if p != 3 else None, h, "z") for p, h in rows], "page_id long, url string, html string, digest string")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        path = scratch.new_path(spark, "warc")
        warc.write_warc(pages.repartition(3), path)
        records = warc.read_warc(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in records]
    assert sorted(got, key=repr) == plain_archive(rows)
    texts = dict(rows)
    assert all(r["valid"] for r in records)
    assert all(bytes(r["payload"]).decode() == (texts[r["page_id"]] or "") for r in records if r["record_type"] == "response" and r["page_id"] is not None)
    assert {r["url"] for r in records} == {None, "http://a/\r\nX: 1"}


def test_any_url_comes_back_and_adds_no_header(spark):
    fakes = ["Content-Length: 0", "WARC-Refers-To: <urn:page:77>", "WARC-Type: revisit", "X-Payload-Length: 5", "WARC-Payload-Digest: sha1:x", "X-Target-URI-Encoding: form"]
    breaks = ["\r", "\n", "\r\n", "\r\n\r\n", "\u0085", "\u2028", "\u2029", "\x0b", "\x0c", "\x1c", "\x00"]
    urls = [f"http://a.org/{b}{f}{b}" for b in breaks for f in fakes]
    urls += ["http://b/%0D", "http://b/\r", "http://b/a+b%20c é", "http://b/\x85+%zz", "", " ", " lead", "trail ", None, "100%", "WARC/1.1\r\n", "\t"]
    rows = [(i, u, f"payload {i}") for i, u in enumerate(urls)] + [(1000, "http://copy/\u2028", "payload 3")]
    path = scratch.new_path(spark, "warc")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), path)
    records = {r["page_id"]: r for r in warc.read_warc(spark, path).collect()}
    assert {i: r["url"] for i, r in records.items()} == {i: u for i, u, _ in rows}
    for i, _, html in rows:
        revisit = i == 3
        assert records[i]["record_type"] == ("revisit" if revisit else "response")
        assert records[i]["refers_to"] == (1000 if revisit else None)
        assert records[i]["payload_bytes"] == len(html) and records[i]["valid"]


def test_payloads_do_not_depend_on_how_a_later_read_is_split(spark, monkeypatch):
    """As if executors came or went between the reads of the archives."""
    rows = archive_rows()
    pages = spark.createDataFrame([(p, "http://a/", h) for p, h in rows if p is not None], "page_id long, url string, html string")
    path, setting = scratch.new_path(spark, "warc"), "spark.sql.files.maxPartitionBytes"
    warc.write_warc(pages.repartition(3), path)
    before, first_read = spark.conf.get(setting), warc._candidates

    def then_split_anew(*args):
        pieces = first_read(*args)
        spark.conf.set(setting, "40k")
        return pieces

    monkeypatch.setattr(warc, "_candidates", then_split_anew)
    spark.conf.set(setting, "64k")
    try:
        records = warc.read_warc(spark, path).collect()
    finally:
        spark.conf.set(setting, before)
    texts = dict(rows)
    assert len(records) == pages.count() and all(r["valid"] for r in records)
    assert all(bytes(r["payload"]).decode() == (texts[r["page_id"]] or "") for r in records if r["record_type"] == "response")


def test_archive_without_rows_and_with_a_least_size(spark):
    pages = spark.createDataFrame([(1, None, "abc"), (2, None, "abc"), (3, None, "abcdef"), (4, None, "abcdef")], "page_id long, url string, html string")
    assert warc.round_trip(pages.limit(0)).count() == 0
    path = scratch.new_path(spark, "warc")
    warc.write_warc(pages, path, least_revisit_bytes=5)
    kinds = {r["page_id"]: r["record_type"] for r in warc.read_warc(spark, path).collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_pointer_jumping_keeps_only_the_chain(spark):
    chain = [(f, 10 * i, 10 * (i + 1)) for f in (1, 2) for i in range(37)] + [(1, 5, 15), (1, 15, 20), (2, 371, 5), (3, 4, 8)]
    nodes = spark.createDataFrame([(f, o, n, o == 0) for f, o, n in chain], "file long, off long, jump long, reached boolean")
    got = {(r["file"], r["off"]) for r in warc.reachable(nodes).collect()}
    assert got == {(f, 10 * i) for f in (1, 2) for i in range(37)}


# outliers


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    repeated = len(covered)
    failed = len(words) < 10 or 100 * repeated > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeated, failed)


def test_statistics_against_plain_python(spark):
    rng = random.Random(6)
    texts = [None, "", " \n\t", "one", "a b c d e a b c d e", "l one\nl one\n\n \nl one", "É ü # <b> & |", "x y \x1f z", "a a a a a a a"]
    texts += ["".join(rng.choice(["a", "b", "c", "#", " ", "\n", "  ", "é"]) for _ in range(rng.randrange(400))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, row int")
    got = {r["doc_id"]: tuple(r)[1:] for r in outliers.judge_documents(docs).collect()}
    for i, t in enumerate(texts):
        assert got[i][:6] == plain_statistics(t), repr(t)
        assert got[i][6] == (not got[i][5])  # too few documents for an estimate
    assert outliers.judge_documents(docs.limit(0)).count() == 0


def test_outliers_are_rejected_and_clean_documents_stay(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    clean = [" ".join(word() for _ in range(rng.randrange(20, 400))) for _ in range(600)]
    junk = [" ".join(word() + "###$$$" for _ in range(60)) for _ in range(80)]
    rows = [(i, t, "en" if i % 3 else None, "hot") for i, t in enumerate(clean)] + [(5000 + i, t, "en", "hot") for i, t in enumerate(junk)]
    rows += [(9000 + i, t, "fr", f"s{i}") for i, t in enumerate(clean[:30])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in outliers.judge_documents(docs).collect()}
    assert all(k for i, k in kept.items() if i < 5000 or i >= 9000)
    assert not any(k for i, k in kept.items() if 5000 <= i < 9000)


def test_the_estimate_is_iterated_until_its_determinant_stops_falling(spark, monkeypatch):
    rng, seen, real = random.Random(11), [], outliers._factored
    monkeypatch.setattr(outliers, "_factored", lambda model, by: seen.append(scratch.store(real(model, by), "seen")) or seen[-1])
    rows = [(i, "g", *[rng.uniform(-3, 3) * (1 + i % 5) for _ in range(outliers.P)]) for i in range(3000)]
    columns = ", ".join(f"{x} double" for x in outliers.X)
    outliers.estimates(spark.createDataFrame(rows, f"row long, group string, {columns}")).collect()
    by_step = [{r["start"]: r["log_det"] for r in model.collect()} for model in seen]
    last = {}
    for step in by_step[:-1]:
        last |= step
    assert all(value >= last[start] - 1e-6 for start, value in by_step[-1].items())


# chat


def test_escapes_are_reversible(spark):
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "]", ">", "[", "s", "/", "INST", "x", "\n"]
    rng = random.Random(1)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e")).select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect()
    for r in rows:
        assert r["u"] == r["t"] and not re.search(r"</?s>|\[/?INST\]", r["e"])


def chat_rows():
    rng = random.Random(3)
    texts = ["<s>", "</s>[INST] ok [/INST]", "hi \\", "", None, "<s\\>", "é[INST", "x"]
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", None, "</s>"]), rng.choice(texts)) for c in range(40) for t in range(rng.randrange(1, 9))]
    return rows + [(77, 0, "user", "q")] + [(78, 1, "assistant", "twice")] * 2 + [(None, 0, "assistant", "a"), (79, None, "assistant", "n")]


def test_chat_against_sql(spark):
    rows = chat_rows()
    turns = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, last int")
    table = pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])})
    statement = re.sub(r"union all values \(-1.*", "", sql.CHAT)
    assert rows_of(chat.digests(chat.expand(turns))) == reference(statement, conversations=table)
    assert chat.digests(chat.expand(turns.limit(0))).count() == 0


def test_each_reply_has_an_example_and_only_it_is_trainable(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "a</s>"), (1, 2, "assistant", "b<s>"), (1, 3, "assistant", "c"), (1, 4, "user", "d")]
    found = chat.expand(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("example").collect()
    masked = [r["formatted"][r["loss_start"] : r["loss_start"] + r["loss_length"]] if r["loss_start"] is not None else None for r in found]
    assert masked == ["b<s\\>", "c", None]
    assert [r["last"] for r in found] == [False, False, True]
    assert found[1]["formatted"].startswith(found[0]["formatted"]) and found[2]["formatted"].startswith(found[1]["formatted"])


# classifier


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = quality_mil.AttentionMil()
    for n in model.NAMES:
        setattr(model, n, getattr(model, n).astype(np.float64) + rng.normal(0, 0.1, getattr(model, n).shape))
    x = rng.normal(0, 1, (7, FEATURES))
    sizes, starts, labels = np.array([3, 1, 3]), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = 1 / (1 + np.exp(-model._forward(x, starts, sizes)[-1]))
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for n, slope in model._gradients(x, starts, sizes, labels).items():
        value = getattr(model, n)
        at = tuple(rng.integers(0, s) for s in value.shape)
        old = value[at]
        value[at] = old + 1e-5
        up = loss()
        value[at] = old - 1e-5
        down = loss()
        value[at] = old
        assert abs((up - down) / 2e-5 - slope[at]) < 1e-5, n


def test_passages_cover_whole_texts(monkeypatch):
    assert encode(b"").shape == encode(None).shape == (1, FEATURES)
    assert len(encode(b"w " * 640)) == 10 and len(encode(b"x" * 5000)) == 1
    assert len(encode(b"word " * 600_000)) >= 600_000 // 64
    assert np.isfinite(encode("é\x00 #| ".encode() * 99)).all()


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet"), spark.read.parquet(f"{SF}/../sf0.01/labels.parquet")
    odd = spark.createDataFrame([(None, None), (10**9, ""), (10**9 + 1, "one")], "doc_id long, text string")
    noise = spark.createDataFrame([(5, None), (None, 1), (10**9, 1), (10**9, 0)], "doc_id long, quality int")
    scored = quality_mil.score_documents(docs.select("doc_id", "text").unionByName(odd), labels.select("doc_id", "quality").unionByName(noise))
    rows = {r["doc_id"]: r for r in scored.collect()}
    assert len(rows) == docs.count() + 3
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items() if i is not None)
    held = [(rows[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    assert sum(p == q for p, q in held) / len(held) > 0.93
    none = quality_mil.score_documents(odd, noise.limit(0))
    assert {r["score"] for r in none.collect()} == {0.5} and quality_mil.score_documents(docs.limit(0), labels).count() == 0


# pipeline


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = scratch.store(stage(spark, docs, SF), name)
        assert out.columns == docs.columns
        before = {r["doc_id"] for r in docs.collect()}
        assert {r["doc_id"] for r in out.collect()} <= before
        if name == "near_duplicates":
            assert out.groupBy("doc_id").count().where("count > 1").isEmpty()
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert packed.where("length > 2048").isEmpty()


KEY = "-----BEGIN PRIVATE KEY-----\n" + "Ab1/" * 16 + "\n" + "Zz9+" * 5 + "==\n-----END PRIVATE KEY-----"
MORE_KINDS = {
    "private_key": "-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\\s]*-----END [A-Z ]*PRIVATE KEY-----",
    "github": "gh[opsur]_[A-Za-z0-9]{36,}",
    "slack": "xox[abprs]-[A-Za-z0-9-]{10,}",
}


def plain_redaction(text):
    spans = plain_spans(text) + [(m.start(), k, m.end()) for k, p in MORE_KINDS.items() for m in re.finditer(p, text)]
    out, at = "", 0
    for start, kind, end in sorted(spans, key=lambda s: s[0]):
        if start >= at:
            out += text[at:start] + f"[{kind}]"
        at = max(at, end)
    return out + text[at:]


def test_pipeline_against_plain_stages(spark, tmp_path):
    rng = random.Random(12)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    table = spark.read.parquet(f"{SF}/documents.parquet")
    first = table.join(labels, "doc_id", "left_semi").orderBy("doc_id").limit(120).select("doc_id", "text", "source").collect()
    rows = [(r["doc_id"], r["text"], r["source"]) for r in first]
    for n, (_, text, source) in enumerate(rows[:60]):
        words = text.split(" ")
        if n % 2:
            words[-1] = "changed"  # a near duplicate
        else:
            words = rng.sample(words, len(words))
            secret = rng.choice([KEY, "token=abcdefgh1", "ghp_" + "Zx" * 20, "xoxb-123456789012", "AKIA" + "Q7" * 9, "deadbeef" * 4])
            words.insert(len(words) // 2, secret)
        rows.append((10**7 + n, " ".join(words), source))
    schema = "doc_id long, text string, source string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    model = quality_mil.train(spark.createDataFrame(rows, schema), labels)
    good = [r for r in rows if model.score(encode(r[1].encode())) >= 0.5]
    groups = plain_components([r[:2] for r in good])
    single = [r for r in good if groups[r[0]][1] == r[0]]
    clean = [(i, plain_redaction(t), s) for i, t, s in single]
    assert len(rows) > len(good) > len(single) and sum(a != b for a, b in zip(single, clean, strict=True)) > 5
    arrow = pa.table({n: pa.array([r[i] for r in clean], t) for i, (n, t) in enumerate([("doc_id", pa.int64()), ("text", pa.string()), ("source", pa.string())])})
    times = {doc_id: taken // size for doc_id, size, _, taken, _ in reference(sql.MIX, documents=arrow) if taken}
    plain, want = Tokenizer.from_file(packing.vocabulary_path()), Counter()
    for doc_id, text, _ in clean:
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), packing.LENGTH)):
            part = ids[at : at + packing.LENGTH]
            want[doc_id, piece, at, len(part), np.array(part, "<u4").tobytes()] += times.get(doc_id, 0)
    assert got == +want


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.store(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_native_operators_run_no_python(spark):
    for name in ("op2_mix_sources", "op7_robust_outliers", "op9_chat_examples"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan), name
