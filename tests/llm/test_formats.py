"""Chat windows, segment files, packing and shards: exact round trips and brute force."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from handoff.llm import chat_windows, elias_fano, hilbert_shards, queries, variable_packing
from handoff.llm.common import open_folder, shared_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
HARD = ["</s>[INST] ok [/INST]", "<|turn|>x<|text|>", "back\\slash \\\\ <\\|", "", "[[INST]]<s>", "ü\n\t<|end|>", None]


def conversation(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cell long, n long")


def expected(rows):
    """The digests by plain code."""
    out = {}
    groups = {}
    for conv, turn, role, text, *_ in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in groups.items():
        turns.sort()
        told = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def hard_rows():
    rng = np.random.default_rng(5)
    rows = []
    for conv in range(30):
        n = int(rng.integers(1, 12))
        for turn in range(n):
            role = "system" if turn == 0 and conv % 3 == 0 else ("user", "assistant")[turn % 2]
            text = HARD[int(rng.integers(0, len(HARD)))] if rng.random() < 0.5 else "word " * int(rng.integers(0, 60))
            rows.append((conv, turn, role, text, 1, 1))
    rows += [(50, t, ("user", "assistant")[t % 2], f"turn {t} of a long conversation", 1, 1) for t in range(400)]
    rows += [(60, 0, "assistant", "x" * 5000, 1, 1), (None, 1, None, "no id", 1, 1), (None, None, "assistant", None, 1, 1)]
    rows += [(70, 3, "assistant", "same", 1, 1)] * 3
    return rows


def test_windows_give_every_turn_back_and_mask_each_target_once(spark):
    rows = hard_rows()
    for budget, history in ((200, 60), (400, 0), (100000, 500)):
        windows = chat_windows.windows(conversation(spark, rows), budget=budget, history=history)
        got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat_windows.digests(windows).collect()}
        assert got == expected(rows)


def test_windows_keep_budget_system_turn_and_history(spark):
    rows = hard_rows()
    budget, history = 300, 80
    windows = chat_windows.windows(conversation(spark, rows), budget=budget, history=history).collect()
    assert len(windows) > 60
    by_conv = {}
    for w in sorted(windows, key=lambda w: (w["cell"], w["over"])):
        turns = chat_windows.parse(w["text"])
        sizes = [len((chat_windows.TURN + x).encode()) for x in w["text"].split(chat_windows.TURN)[1:]]
        assert sum(sizes) == w["n_tokens"]
        new = turns[w["n_repeated"]:]
        earlier = by_conv.setdefault(w["conv_id"], [])
        lead = sizes[0] if turns[0][0] == "system" else 0
        own_new = [n for n, t in list(zip(sizes, turns))[w["n_repeated"]:] if t[0] != "system"]
        # over budget only where one new turn and the system turn alone are
        assert w["n_tokens"] <= budget or (len(own_new) == 1 and lead + own_new[0] > budget and w["n_tokens"] == lead + own_new[0])
        assert w["over_budget"] == (w["n_tokens"] > budget)
        if earlier and earlier[0][0] == "system":
            assert turns[0] == earlier[0] and w["n_repeated"] >= 1
        past = turns[: w["n_repeated"]]
        past = past[1:] if past and past[0][0] == "system" else past
        assert past == earlier[len(earlier) - len(past):]
        own = sizes[w["n_repeated"] - len(past): w["n_repeated"]]
        assert sum(own) <= history
        earlier += new
        assert [chat_windows.unescape(w["text"][s["start"]: s["end"]]) for s in w["loss_spans"]] == [t for r, t in new if r == "assistant"]


@pytest.mark.parametrize(("lead", "last"), [(0, 900), (0, 1000), (0, 1024), (0, 1030), (300, 700), (600, 420), (900, 100), (1100, 30)])
def test_a_long_turn_gets_only_the_history_that_is_left(spark, lead, last):
    """Turns of known sizes (tokens are counted by the text's length): eight of 60, then a long one."""
    rows = [(1, 0, "system", "s" * lead, 1, 1)] if lead else []
    rows += [(1, i, ("user", "assistant")[i % 2], "x" * 60, 1, 1) for i in range(1, 9)] + [(1, 9, "assistant", "y" * last, 1, 1)]
    size = F.greatest(F.lit(1), F.length(F.regexp_extract("piece", r"([sxy]+)<\|end", 1)))
    windows = chat_windows.windows(conversation(spark, rows), size, budget=1024, history=256).collect()
    for w in windows:
        turns = [t for _, t in chat_windows.parse(w["text"])]
        new = turns[w["n_repeated"]:]
        own = [t for t in new if t[0] != "s"]
        assert w["n_tokens"] == sum(map(len, turns))
        alone = lead >= 1024 or len(own) == 1
        assert w["n_tokens"] <= 1024 or (alone and w["n_tokens"] == lead + sum(map(len, own))), [len(t) for t in turns]
        past = [t for t in turns[: w["n_repeated"]] if t[0] != "s"]
        if own and own[0][0] == "y" and len(own) == 1 and len(windows) > 1:
            assert len(past) == max(0, min(256, 1024 - lead - last)) // 60
    assert sum(len(chat_windows.parse(w["text"])) - w["n_repeated"] for w in windows) == len(rows)


def test_no_control_string_inside_texts(spark):
    rows = [(1, i, "user", t, 0, 0) for i, t in enumerate(HARD)]
    text = chat_windows.windows(conversation(spark, rows), budget=10**6).first()["text"]
    body = text.replace(chat_windows.TURN, "").replace(chat_windows.TEXT, "").replace(chat_windows.END, "")
    assert not any(c in body for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\<|/s>[INT]ab", max_size=30))
def test_escape_is_reversible(text):
    import re

    java = re.sub(chat_windows._CONTROL, lambda m: (m.group(1) or "") + (m.group(2) or "") + "\\", text.replace("\\", "\\\\"))
    assert chat_windows.unescape(java) == text


def test_no_conversations(spark):
    empty = conversation(spark, [])
    assert chat_windows.windows(empty).count() == 0 and chat_windows.digests(chat_windows.windows(empty)).count() == 0


def test_chat_query_on_the_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    rows = [tuple(r) for r in rows] + [(-1, 0, "user", HARD[0]), (-1, 1, "assistant", HARD[0])]
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in queries.op1_chat_windows(spark, "/root/testdata/sf0.01").collect()}
    assert got == expected(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**40), min_size=1, max_size=300))
def test_elias_fano_gives_every_entry_back(values):
    values = sorted(values)
    ef = elias_fano.EliasFano.from_bytes(memoryview(elias_fano.EliasFano.of(np.array(values, dtype=np.uint64)).to_bytes()))
    assert ef.all().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10000))
    assert len(elias_fano.EliasFano.of(ends).to_bytes()) < 0.25 * 8 * len(ends)


TEXTS = ["", "a", " lead", "two  blanks\n \n x", "tab\t y z ", "line\n\nline \n", "emoji 😀 ü\u00a0nbsp \u2003 wide", "don't 12 3,4 --- <|endoftext|> x", "the the  the"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(TEXTS), st.text(alphabet="ab1 .\n\t'\u00a0é", max_size=25)), max_size=6))
def test_word_by_word_encoding_is_the_library_s(texts):
    enc = elias_fano.encoder(TOKENIZER, 2)
    want = [enc.plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert [np.frombuffer(x, dtype="<u2").tolist() for x in enc.encode(texts)] == want


def test_files_give_ids_and_single_documents_back(spark):
    rows = [(i * 7 % 41, TEXTS[i % len(TEXTS)] * (1 + i % 5)) for i in range(41)] + [(None, "no id"), (None, None), (3, "again"), (100, "long " * 30000)]
    docs = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, start long")
    folder = shared_path(spark, "ids")
    files = elias_fano.write(docs, folder, TOKENIZER, 2, segment_ids=300)
    got = elias_fano.read(files, folder).orderBy("start").collect()
    enc = elias_fano.encoder(TOKENIZER, 2)
    want = {}
    for i, t in rows:
        ids = np.array(enc.plain.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    at, found = 0, {}
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        found.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    fs, root = open_folder(folder)
    assert files.count() >= 4
    for f in files.collect():
        with fs.open_input_stream(f"{root}/{f['file']}") as source:
            segment = elias_fano.Segment(source.read())
        parts = [segment.document(i) for i in range(segment.n)]
        assert np.array_equal(np.concatenate(parts), segment.ids) and all(p[-1] == 2 for p in parts)


def test_no_documents_write_no_files(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert elias_fano.write_and_read(spark, docs, TOKENIZER, 2).count() == 0
    assert variable_packing.pack(docs).count() == 0
    assert hilbert_shards.shard_rows(docs, ["doc_id"], 4).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60), st.integers(0, 20))
def test_best_fit_is_valid_and_never_dearer_than_one_size(lengths, bin_cost):
    sizes = (16, 32, 64)
    lengths = sorted(lengths, reverse=True)
    bins, offsets, capacity = variable_packing.pack_group(lengths, sizes, bin_cost)
    for b, size in enumerate(capacity):
        own = sorted((offsets[i], lengths[i]) for i in range(len(lengths)) if bins[i] == b)
        assert own[0][0] == 0 and all(o + n == o2 for (o, n), (o2, _) in zip(own, own[1:]))
        used = own[-1][0] + own[-1][1]
        assert size == min(s for s in sizes if s >= used)
    cost = sum(capacity) + bin_cost * len(capacity)
    for only in sizes:
        _, _, other = variable_packing.best_fit(lengths, sizes, bin_cost, only)
        assert cost <= sum(other) + bin_cost * len(other)


def optimum(lengths, sizes, bin_cost):
    """Least cost over all partitions of a few pieces."""
    best = [float("inf")]

    def place(i, used):
        if i == len(lengths):
            best[0] = min(best[0], sum(min(s for s in sizes if s >= u) + bin_cost for u in used))
            return
        for b in range(len(used)):
            if used[b] + lengths[i] <= max(sizes):
                place(i + 1, [*used[:b], used[b] + lengths[i], *used[b + 1:]])
        place(i + 1, [*used, lengths[i]])

    place(0, [])
    return best[0]


def test_best_fit_is_near_the_optimum_of_small_cases():
    rng = np.random.default_rng(2)
    got = want = 0
    for _ in range(60):
        lengths = sorted(rng.integers(1, 33, 7).tolist(), reverse=True)
        _, _, capacity = variable_packing.pack_group(lengths, (8, 16, 32), 2)
        got += sum(capacity) + 2 * len(capacity)
        want += optimum(lengths, (8, 16, 32), 2)
    assert got <= 1.1 * want


def test_packing_places_every_byte_once(spark):
    rows = [(1, "x" * 50000), (2, None), (2, ""), (None, "ab"), (None, "ab"), (3, "é" * 900), (3, "é" * 900)]
    docs = spark.createDataFrame([(i, t, 0, "s") for i, t in rows], "doc_id long, text string, bin_id int, piece string")
    got = variable_packing.pack(docs, group_pieces=3).collect()
    want = sorted(((i is None, i or 0), len((t or "").encode()) + 1) for i, t in rows)
    total = {}
    for r in got:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_ids"]
    assert sum(total.values()) == sum(n for _, n in want) and set(total) == {1, 2, 3, None}
    places = {}
    for r in got:
        places.setdefault(r["bin_id"], []).append((r["offset"], r["n_ids"], r["bin_used"], r["bin_size"]))
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:]))
        assert own[-1][0] + own[-1][1] == own[0][2] <= own[0][3]
    pieces = sorted((r["piece"], r["start"], r["n_ids"]) for r in got if r["doc_id"] == 1)
    assert pieces == [(0, 0, 16384), (1, 16384, 16384), (2, 32768, 16384), (3, 49152, 849)]


def test_packing_by_the_tokenizers_ids(spark):
    texts = [*TEXTS, None, "long text " * 30_000, "w" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    enc = elias_fano.encoder(TOKENIZER, 2)
    want = {i: len(enc.plain.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    got = {}
    for r in variable_packing.pack(docs, length=variable_packing.token_length(TOKENIZER)).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["n_ids"]
    assert got == want


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (1, 5)])
def test_hilbert_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1)
    index = hilbert_shards.hilbert_index(list(cells), bits)
    assert sorted(index.tolist()) == list(range(cells.shape[1]))
    path = cells[:, np.argsort(index)]
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def test_shards_hold_every_row_once_in_equal_runs(spark):
    rows = [(i, "t" * (i % 13), "en" if i % 3 else None, float(i % 7) if i % 5 else float("nan"), "x") for i in range(203)]
    rows += [(5, None, "en", None, "y")] * 20 + [(None, "same", "de", float("inf"), "z")] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n double, shard string")
    out = hilbert_shards.write_shards(docs, ["lang", "n", "doc_id"], 10, shared_path(spark, "shards"))
    assert set(docs.columns) - {"shard"} | {"_shard", "shard", "slot", "curve"} == set(out.columns)
    got = out.collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(key((r["doc_id"], r["text"], r["lang"], r["n"], r["_shard"])) for r in got) == sorted(map(key, rows))
    sizes = {}
    for r in got:
        sizes.setdefault(r["shard"], []).append(r["slot"])
    assert set(sizes) == set(range(10)) and max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    ends = sorted((s, min(r["curve"] for r in got if r["shard"] == s), max(r["curve"] for r in got if r["shard"] == s)) for s in sizes)
    assert all(a[2] <= b[1] for a, b in zip(ends, ends[1:]))


def plain_shards(rows, dims, shards):
    """Rows (as dictionaries) sorted by curve index, text hash and id on one machine, and cut."""
    cell = {}
    for d in dims:
        values = sorted(r[d] for r in rows if r[d] is not None)
        cuts = sorted({values[max(0, -(-i * len(values) // 256) - 1)] for i in range(1, 256)}) if values else []
        cell[d] = [sum(c < r[d] for c in cuts) if r[d] is not None else 0 for r in rows]
    curve = hilbert_shards.hilbert_index([np.array(cell[d]) for d in dims], hilbert_shards.BITS).tolist()
    order = sorted(range(len(rows)), key=lambda i: (curve[i], rows[i]["hash"], rows[i]["doc_id"]))
    starts = [-(-s * len(rows) // shards) for s in range(shards + 1)]
    return {rows[i]["doc_id"]: (curve[i], s, k - starts[s]) for s in range(shards) for k, i in enumerate(order) if starts[s] <= k < starts[s + 1]}


def test_sharding_is_the_plainly_sorted_table(spark):
    rng = np.random.default_rng(4)
    docs = spark.createDataFrame([(i, "t" * int(rng.integers(0, 5)), int(a), None if b < 4 else int(b)) for i, (a, b) in enumerate(rng.integers(0, 50, (500, 2)))],
                                 "doc_id long, text string, a long, b long").repartition(4)
    rows = [r.asDict() for r in docs.withColumn("hash", F.xxhash64("text")).collect()]
    got = {r["doc_id"]: (r["curve"], r["shard"], r["slot"]) for r in hilbert_shards.shard_rows(docs, ["a", "b"], 7).collect()}
    assert got == plain_shards(rows, ["a", "b"], 7)


def test_sharding_carries_columns_of_any_name(spark):
    names = ["rank", "first", "part", "place", "_place", "n", "Shard", "_shard", "slot", "curve", "a.b"]
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), *[(F.col("id") * k).alias(c) for k, c in enumerate(names)])
    got = hilbert_shards.shard_rows(docs, ["a.b", "rank", "slot"], 4)
    kept = {"Shard": "__Shard", "slot": "_slot", "curve": "_curve"}
    assert got.columns == ["doc_id", "text", *[kept.get(c, c) for c in names], "curve", "shard", "slot"]
    for r in got.collect():
        assert all(r[kept.get(c, c)] == r["doc_id"] * k for k, c in enumerate(names))


def test_runs_prune_on_every_dimension(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), (F.col("id") % 64).alias("a"), F.floor(F.col("id") / 63).alias("b"))
    got = hilbert_shards.shard_rows(docs, ["a", "b"], 16).groupBy("shard").agg(*[f(c).alias(f"{k}{c}") for c in "ab" for k, f in (("lo", F.min), ("hi", F.max))]).collect()
    for c in "ab":
        width = np.mean([r[f"hi{c}"] - r[f"lo{c}"] for r in got])
        assert width < 0.5 * 64


def test_fewer_rows_than_shards(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    got = hilbert_shards.shard_rows(docs, ["doc_id"], 40).collect()
    assert len(got) == 2 and {r["slot"] for r in got} == {0} and all(0 <= r["shard"] < 40 for r in got)


def test_shard_query(spark):
    got = queries.op10_hilbert_shards(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


# ---------------------------------------------------------------- words that go to the library together
def test_new_words_are_sent_as_text_and_counted_without_ids(monkeypatch):
    """op3, op7: words after a blank need no special token between them, and lengths keep numbers only."""
    texts = ["one two  three\n four <|endoftext|> x<|endoftext|>y Ġa  b it's 12", "", " ", "  lead", "tail ", "Ġ ĠĠ q", "a \t b c  d"]
    sent, plain = [], elias_fano.Encoder._encode
    monkeypatch.setattr(elias_fano.Encoder, "_encode", lambda self, t: sent.extend(t) or plain(self, t))
    enc = elias_fano.Encoder(TOKENIZER, 2)
    many = [f"w word{i} and{i % 7}" for i in range(400)]
    want = [e.ids + [2] for e in enc.plain.encode_batch(texts + many, add_special_tokens=False)]
    assert enc.lengths(texts + many) == [len(w) for w in want]
    assert not enc.later and sum(enc.mark in t for t in sent) <= 4
    assert [np.frombuffer(b, f"<u{enc.width}").tolist() for b in enc.encode(texts + many)] == want
    assert enc.lengths(many[::-1] + texts, kept=10) == [len(w) for w in want[7:][::-1] + want[:7]]  # forgotten and learned again
