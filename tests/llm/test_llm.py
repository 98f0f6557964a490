"""The llm operators against brute force, libraries and round trips, and on odd rows."""

import collections
import hashlib
import itertools
import json
import math
import random
import zlib

import numpy as np
import pytest

from plumbline.llm import (
    block_naming, jaccard_join, line_dedup, packing, pieces, ppm, prefix_tokens, quality, sentencepiece_fst, toxicity, warc_index)

SCHEMA = "doc_id bigint, text string, key string, node string, n long, word string"
LONG = "word " * 3000 + "x" * 5000


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", "g", 1, "w") for i, t in rows], SCHEMA)


def invented(seed=1, n=60):
    """Texts with exact copies, near copies, shared lines, nulls, ties and a long one."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice(["th", "er", "on", "an", "Re", "é"]) for _ in range(draw.randint(1, 4)))
    line = lambda k: " ".join(word() for _ in range(k))
    shared = [line(12) for _ in range(4)]
    rows = []
    for i in range(n):
        if i % 5 == 4:
            w = rows[-1][1].split(" ")
            w[draw.randrange(len(w))] = word()
            rows.append((i, " ".join(w)))
        elif i % 7 == 6:
            rows.append((i, rows[-2][1].replace(" ", "\t ")))
        else:
            rows.append((i, "\n".join([line(40), draw.choice(shared), line(3), line(30)])))
    return [*rows, (n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "one two"), (n + 4, "ONE two"), (n + 5, LONG), (None, rows[0][1]), rows[3], (3, "another text for one id")]


def shingles(words):
    return {tuple(words[i: i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def linked(a, b):
    both = len(a & b)
    return bool(a and b) and 100 * both >= 80 * (len(a) + len(b) - both)


def test_every_operator_takes_an_empty_table(spark):
    empty = frame(spark, [])
    assert quality.apply_policy(quality.ledger(empty)).count() == 0
    assert block_naming.exact_duplicates(empty).count() == 0
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert line_dedup.deduplicated(empty).count() == 0
    assert prefix_tokens.budgets(empty, 5).count() == 0
    assert sentencepiece_fst.round_trips(empty).count() == 0
    assert packing.best_fit(packing.pieces(empty, "word_bpe_49k.json")).count() == 0
    assert ppm.scored(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.trained(empty, labels) is None and toxicity.scored(empty, None).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    index = warc_index.build_index(warc_index.write_archives(pages))
    assert warc_index.read_records(warc_index.look_up(index, pages)).count() == 0


def test_quality_counts_repeated_windows(spark):
    rows = [(1, "aa bb cc dd ee aa bb cc dd ee"), (2, None), (3, "x\nx\n \ny"), (4, "a b c d e f g")]
    got = {r.doc_id: r for r in quality.apply_policy(quality.ledger(frame(spark, rows))).collect()}
    assert (got[1].n_words, got[1].n_repeat_words, got[4].n_repeat_words) == (10, 10, 0)
    assert (got[2].n_words, got[2].base_failed, got[2].kept) == (0, True, False)
    assert (got[3].n_dup_lines, got[3].n_lines) == (1, 3)
    report = {r.rule: r for r in quality.ablation(quality.ledger(frame(spark, rows))).collect()}
    assert report["short"].failed == 3 and report["repeated_windows"].failed_alone == 1


@pytest.mark.parametrize("bits", [64, 2])
def test_block_names_tell_texts_apart(spark, bits):
    rows = invented()
    got = block_naming.exact_duplicates(frame(spark, rows), block_bytes=16, hash_bits=bits).collect()
    plain = lambda t: " ".join(__import__("re").split(r"[\x20\x09-\x0D]+", t or ""))
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[plain(t)].append(i)
    want = sorted(
        (str(i), min(x for x in groups[plain(t)] if x is not None), len(groups[plain(t)]), hashlib.sha256(plain(t).encode()).hexdigest())
        for i, t in rows)
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.text_sha256) for r in got) == want


def test_components_of_near_copies(spark):
    rows = invented(2)
    got = jaccard_join.near_duplicates(frame(spark, rows)).collect()
    sets = [(i, shingles((t or "").encode().lower().split())) for i, t in rows]
    comp = {i: i for i, _ in sets if i is not None}
    for _ in range(len(comp)):
        for (i, a), (j, b) in itertools.combinations(sets, 2):
            if i is not None and j is not None and linked(a, b):
                comp[i] = comp[j] = min(comp[i], comp[j])
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == sorted(
        ((str(i), len(a), comp.get(i)) for i, a in sets), key=lambda x: (x[0], x[1]))


def test_later_matching_lines_go(spark):
    rows = [r for r in invented(3) if r[0] is not None and r != (3, "another text for one id")]
    rows = list({i: (i, t) for i, t in rows}.values())
    got = {r.doc_id: r for r in line_dedup.deduplicated(frame(spark, rows)).collect()}
    seen, want = [], collections.defaultdict(list)
    for i, t in sorted(rows):
        for no, line in enumerate((t or "").split("\n")):
            words = line.encode().lower().split()
            if len(words) >= 5:
                own = shingles(words)
                if any(linked(own, s) for s in seen):
                    want[i].append(no)
                seen.append(own)
    assert {i: list(r.removed_lines) for i, r in got.items()} == {i: want[i] for i, _ in rows}
    for i, t in rows:
        kept = None if t is None else "\n".join(x for no, x in enumerate(t.split("\n")) if no not in want[i])
        assert got[i].text == kept and got[i].word == "w"


def test_prefix_counts_and_paths_match_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=prefix_tokens.model(prefix_tokens.MODEL) and
                                                   __import__("plumbline.llm.common", fromlist=["x"]).vocabulary(prefix_tokens.MODEL))
    odd = ["", " ", "  a  b\n▁c <s> \x00é\t ", "a" * 60, "日本 😀", "\n\n x.y..z ,,", "int main() { return a[i]->b; }"]
    texts = [(i, t) for i, t in enumerate([*odd, *[t for _, t in invented(4, 10) if t]])]
    machine = sentencepiece_fst.machine_of(sentencepiece_fst.MODEL)
    tables = prefix_tokens.tables_of(prefix_tokens.MODEL)
    for _, t in texts:
        ids = machine.encode(t.encode())
        assert ids.tolist() == library.encode(t) and machine.decode(ids).decode() == t.replace("▁", " ")
        counts = prefix_tokens.counts(tables(t.encode()))
        for k in {0, 1, len(t) // 2, len(t)} & set(range(min(len(t), 400) + 1)):
            assert counts[k] == len(library.encode(t[:k]))
    got = {r.doc_id: r for r in prefix_tokens.budgets(frame(spark, [*texts, (99, None)]), 20).collect()}
    assert all(got[i].n_tokens == len(library.encode(t)) and got[i].n_bytes == len(t.encode()) for i, t in texts)
    assert got[99].n_tokens == 0 and not got[99].over_limit
    assert len(library.encode(texts[-1][1][: got[len(texts) - 1].fit_chars])) <= 20


def test_unigram_shortest_path_is_the_best_segmentation():
    scores = {p: (i, -float(s)) for i, (p, s) in enumerate({"a": 3, "b": 3, "ab": 4, "ba": 3.5, "aba": 7.2, "bb": 5}.items())}
    machine = sentencepiece_fst.Transducer(pieces.PieceModel(scores, {}, pieces.UNIGRAM, prefix=False, unknown=9))
    for text in map("".join, itertools.product("ab", repeat=6)):
        def best(t):
            return 0.0 if not t else max(scores[t[:k]][1] + best(t[k:]) for k in range(1, 4) if t[:k] in scores)
        names = {i: s for i, s in scores.values()}
        assert math.isclose(sum(names[i] for i in machine.shortest(text)), best(text))


def test_packing_is_gapless_and_tight(spark):
    from tokenizers import Tokenizer

    from plumbline.llm.common import vocabulary

    rows = invented(5)
    own = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = packing.best_fit(packing.pieces(frame(spark, rows), "word_bpe_49k.json", capacity=64), 64).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = own.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 64)):
            want[(i, k, at, len(ids[at: at + 64]), zlib.crc32(np.array(ids[at: at + 64], "<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= 1 + math.ceil(1.1 * sum(r.length for r in got) / 64)


@pytest.mark.parametrize("piece, mark, grams, group", [(1 << 20, 1024, 500_000, 8_000_000), (64, 2, 25, 40)])
def test_ppm_matches_a_direct_trie(spark, monkeypatch, piece, mark, grams, group):
    for name, value in {"PIECE": piece, "MARK": mark, "RANGE_GRAMS": grams, "GROUP_GRAMS": group}.items():
        monkeypatch.setattr(ppm, name, value)
    rows = [r for r in invented(6, 30) if r[1] != LONG]
    got = collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 5)) for r in ppm.scored(frame(spark, rows)).collect())
    k, words = ppm.ORDER, [(i, (t or "").encode().lower().split()) for i, t in rows]
    seen, grams = collections.Counter(), collections.Counter()
    line = lambda w: b"\n" * k + b" ".join(w) + b"\n"
    for i, w in words:
        if not ppm.held_out(i):
            seen.update([*w, "end"])
            grams.update(line(w)[j - k: j + 1] for j in range(k, len(line(w))))
    nodes = collections.defaultdict(dict)
    for _ in range(k + 1):
        for g, n in grams.items():
            nodes[g[:-1]][g[-1]] = n
        grams = collections.Counter(g[1:] for g in grams)

    def chance(context, byte):
        ruled, log = {}, 0.0
        for m in range(k, -1, -1):
            node = nodes.get(context[k - m:])
            if node is None:
                continue
            left = {b: n for b, n in node.items() if b not in ruled}
            if left:
                if byte in left:
                    return log + math.log10((left[byte] - 0.5) / sum(left.values()))
                log += math.log10(0.5 * len(left) / sum(left.values()))
            ruled = node
        return log - math.log10(256 - len(ruled))

    total, kinds = sum(seen.values()), len(seen)
    want = collections.Counter()
    for i, w in words:
        own = [*w, "end"]
        want[(i, len(own), sum(seen[x] > 0 for x in own), total,
              round(sum(math.log10((seen[x] + 1) / (total + kinds + 1)) for x in own), 6),
              round(sum(chance(line(w)[j - k: j], line(w)[j]) for j in range(k, len(line(w)))), 5))] += 1
    assert got == want
    assert math.isclose(sum(10 ** chance(b" ther", b) for b in range(256)), 1.0)


def test_toxicity_learns_a_stem_and_its_gradients_hold(spark):
    net = toxicity.Network(3)
    words, place = [b"aa", b"bcd", b"e"], np.array([[0, 1], [2, 0], [1, 2]])
    real, label = np.array([[True, True], [True, True], [False, True]]), np.array([1.0, 0.0], np.float32)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)

    def loss():
        gates = net.project(net.inputs(words)[0])[place] * real[:, :, None]
        z = net.pool(net.read(gates)[0], real)[2]
        return float(np.mean(np.log1p(np.exp(-z)) * label + np.log1p(np.exp(z)) * (1 - label)))

    before = loss()
    for _ in range(60):
        net.learn(words, place, real, label, 0.01)
    assert loss() < before / 2
    draw = random.Random(9)
    filler = ["".join(draw.choice(["th", "er", "on"]) for _ in range(3)) for _ in range(200)]
    rows = []
    for i in range(400):
        text = [draw.choice(filler) for _ in range(draw.randint(5, 90))]
        if i % 3 == 0:
            text.insert(draw.randrange(len(text)), "zog" + draw.choice(["en", "la", "mu", "ti"]))
        rows.append((i, " ".join(text)))
    docs, labels = frame(spark, rows), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)] + [(None, 1), (7, None)], "doc_id bigint, toxic int")
    scores = toxicity.scored(frame(spark, [*rows, (500, None), (501, LONG)]), toxicity.trained(docs, labels)).collect()
    held = [r for r in scores if r.held_out and r.doc_id < 400]
    assert sum(r.predicted == int(r.doc_id % 3 == 0) for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scores)


def test_archives_are_found_by_key_and_read_back(spark):
    urls = ["http://www.a.com/x?q=1", "https://b.a.com:8443/", None, "not a url", "http://[bad"]
    rows = [(i, urls[i % 5], f"<p>{i % 9}</p>\r\n\r\né" if i % 4 else None) for i in range(80)] + [(None, urls[0], "null id")]
    pages = spark.createDataFrame([(*r, "k", "f") for r in rows], "page_id bigint, url string, html string, key string, file string")
    index = warc_index.build_index(warc_index.write_archives(pages), lines=7)
    got = warc_index.read_records(warc_index.look_up(index, pages)).collect()
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = i
    for r in got:
        body = (dict((i, h) for i, _, h in rows)[r.page_id] or "").encode()
        keep = last.get(body.decode(), r.page_id)
        assert (r.payload_bytes, r.refers_to) == (len(body), None if keep == r.page_id else keep)
        assert r.record_type == ("response" if keep == r.page_id else "revisit")
        assert r.payload == (body if keep == r.page_id else None)
    assert collections.Counter(r.page_id for r in got) == collections.Counter(i for i, _, _ in rows)
    assert warc_index.url_key("http://www.a.com/x?q=1") == "com,a,www)/x?q=1"
    assert sum(len(json.loads(r.first)) for r in index.collect()) > 0
