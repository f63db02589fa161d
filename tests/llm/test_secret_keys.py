"""Of a private key nothing is left: header, body and end."""

import random
import string

import pytest

pytest.importorskip("indipanel.llm")

from indipanel.llm import secret_scan  # noqa: E402


def key(end="\n", kind="RSA ", headers=""):
    rng = random.Random(3)
    lines = ["".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(n)) for n in (64, 64, 64, 23)]
    lines[-1] += "="
    return lines, end.join([f"-----BEGIN {kind}PRIVATE KEY-----{headers}", *lines, f"-----END {kind}PRIVATE KEY-----"])


def test_no_byte_of_a_key_is_left(spark):
    pem = "\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-256-CBC,0123AF\n"
    bodies, cut = key()[0], "\n".join(key()[1].split("\n")[:-1])
    texts = ["before\n" + key()[1] + "\nafter it", key("\r\n", "EC ")[1], key("\\n", "")[1], "é " + key(headers=pem)[1] + " after",
             key()[1] + "\nplain prose\n" + key(kind="OPENSSH ")[1], "x " + cut, "x " + cut, "-----BEGIN PRIVATE KEY----- in plain prose", "and more"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs).collect()}
    m = "[SECRET]"
    assert [got[k] for k in range(9)] == [f"before\n{m}\nafter it", m, m, f"é {m} after", f"{m}\nplain prose\n{m}", f"x {m}", f"x {m}",
                                          f"{m} in plain prose", "and more"]
    assert not any(line in t for t in got.values() for line in bodies)
