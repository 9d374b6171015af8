"""Quality measures against a plain count, and host verdicts on planted hosts."""

import random
import re
from collections import Counter

from tidewater.llm import quality as Q

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def rows(seed=1):
    rng = random.Random(seed)
    out = [(0, None), (1, ""), (2, " \n\t\x0b\x0c\r "), (3, "one"), (4, "a b c d e"), (5, "a b c d e " * 5),
           (6, "x" * 50_000), (7, "é中 # $$ <b>|"), (8, "same\nsame\nsame \nother\n\n\n"), (9, "  not a space  "),
           (5, "a b c d e " * 5), (None, "p q r s t u v w x y z")]
    for i in range(10, 60):
        n = rng.choice([5, 20, 200])
        out.append((i, "".join(rng.choice("abc") + rng.choice(["", "#"]) + rng.choice([" ", "\n", "  ", "\t"])
                               for _ in range(n))))
    return [(k, t, "en", None if i % 9 == 0 else f"s{i % 4}", len(t or "")) for i, (k, t) in enumerate(out)]


def test_measures(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 AS n_words", "'x' AS host", "2 AS words", "3 AS kept")
    got = Q.measure(df).selectExpr("doc.doc_id", "doc.text", *Q.MEASURES, "base_failed").collect()
    want = []
    for k, t, *_ in data:
        m = measures(t)
        want.append((k, t, *m, m[0] < 10 or 100 * m[4] > 20 * m[0]))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_hosts(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    good = lambda: " ".join(word() for _ in range(40))
    data, i = [], 0
    for host in range(12):
        for _ in range(60):
            bad = host == 0 and rng.random() < 0.9 or rng.random() < 0.05
            data.append((i, "too short" if bad else good(), "en", f"h{host}", 1))
            i += 1
    data += [(i, "too short", "en", "tiny", 1), (i + 1, good(), "en", "tiny", 1), (i + 2, good(), "en", None, 1)]
    df = spark.createDataFrame(data, SCHEMA)
    measured = Q.measure(df)
    hosts = {r.host: r for r in Q.host_verdicts(measured).collect()}
    assert not hosts["h0"].host_ok and all(hosts[f"h{h}"].host_ok for h in range(1, 12)) and hosts["tiny"].host_ok
    assert hosts["tiny"].rate_few_words < 0.5  # one failure of two is shrunk towards the others
    kept = {r.doc_id for r in Q.keep_good(df).collect()}
    assert kept == {k for k, t, _, s, _ in data if t != "too short" and s != "h0"}
    assert Q.keep_good(df).columns == df.columns


def test_one_host_and_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert Q.keep_good(empty).count() == 0 and Q.host_verdicts(Q.measure(empty)).count() == 0
    df = spark.createDataFrame([(1, "a b c d e f g h i j k", "en", "one", 1), (2, "", "en", "one", 1)], SCHEMA)
    assert [r.doc_id for r in Q.keep_good(df).collect()] == [1]
