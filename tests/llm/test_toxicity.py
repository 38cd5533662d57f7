import random
import zlib

from tallyframe.llm import toxicity as X

SCHEMA = "doc_id long, text string, lang string, source string, score string"


def test_fold_undoes_look_alikes_and_digits():
    assert X.fold("1d10t IDIOT іdіоt ｉｄｉｏｔ id​iot") == " idiot idiot idiot idiot idiot "
    assert X.fold("$tupid m@ron l0s3r tr4$h") == " stupid maron loser trash "
    assert X.fold("2024, 10 $5!") == " 2024 10 5 " and X.fold(None) == X.fold("") == X.fold("?!") .replace("  ", " ")
    assert X.fold("the. end") == " the end "


def test_hits_take_the_longest_pattern_and_skip_exceptions():
    lex, exc = X._automaton({" scum ": 1, " scu": 1, " idiot ": 1}), X._automaton([" pond scum "])
    assert X.hits(X.fold("scum, pond scum and an idiot"), lex, exc) == [" scum ", " idiot "]
    assert X.hits(X.fold("pond scum"), lex, exc) == [] and X.hits(" ", lex, exc) == []
    assert X.hits(X.fold("a prescum"), lex, exc) == []


def data(n=600):
    rng = random.Random(4)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    docs, labels = [], []
    for i in range(n):
        ws = [rng.choice(words) for _ in range(rng.randrange(5, 200))]
        bad = i % 6 == 0
        for _ in range(max(2, len(ws) // 40) if bad else 0):
            ws.insert(rng.randrange(len(ws) + 1), rng.choice(["gruntle", "GRUNTLE", "9runtle".replace("9", "g"), "snarfing", "snarfed"]))
        docs.append((i, " ".join(ws), "en", "s", "x"))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, 1, int(bad)))
    return docs, labels


def test_held_out_accuracy_and_edges(spark):
    docs, labels = data()
    docs += [(None, "gruntle gruntle", None, None, None), (9001, None, "en", "s", ""), (9002, "", "en", "s", ""),
             (9003, "wab " * 40_000, "en", "s", ""), (9004, "gRunt1e snarf1ng you", "en", "s", ""), (9004, "gRunt1e snarf1ng you", "en", "s", "")]
    labels += [(9001, None, None), (None, 1, 1), (0, 1, 0)]  # two labels of one document: toxic counts
    got = X.op3(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    for i in range(600):
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    held = [i for i in range(600) if by[i].held_out]
    assert all(by[i].predicted == int(i % 6 == 0) for i in held)
    assert by[9001].predicted == by[9002].predicted == by[9003].predicted == 0 and by[9004].predicted == 1 and by[None].predicted == 1


def test_without_labels_or_rows(spark):
    docs, _ = data(12)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(docs, SCHEMA)
    assert {r.predicted for r in X.op3(df, none).collect()} == {0}
    assert X.op3(df.limit(0), none).count() == 0
