"""Grouped account numbers with words after them, and assigned secrets."""

import re
import time

import pytest

from matchlens.llm import pii

ACCOUNTS = ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "SE45 5000 0000 0583 9825 7466", "PL61 1090 1014 0000 0712 1981 2874", "GB82 WEST 1234 5698 7654 32"]


def accounts(text):
    return [text[a:b] for kind, a, b, _ in pii.spans_of(text) if kind == "iban"]


@pytest.mark.parametrize("account", ACCOUNTS)
@pytest.mark.parametrize("after", [" BIC CAIXESBB", " BIC", " BANK OF A", " CODE ABCD 12 X", "", "."])
def test_words_after_an_account(account, after):
    text = f"IBAN {account}{after}"
    assert accounts(text) == [account]
    assert pii.redacted(text) == f"IBAN [IBAN]{after}"


def test_accounts_in_a_row():
    assert accounts("account " + " ".join(ACCOUNTS[:3])) == ACCOUNTS[:3]
    assert accounts(f"account AB12 CODE {ACCOUNTS[0]} BIC") == ACCOUNTS[:1]
    assert not accounts("IBAN ES92 2100 0418 4502 0005 1332 BIC")


SECRET = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


@pytest.mark.parametrize("name", ["token = ", "API_KEY: ", "password=>", "mot de passe : ", "Schlüssel=", "secret = '", "contraseña: "])
def test_assigned_secrets(name):
    text = f"words {name}{SECRET}' more"
    assert [text[a:b] for kind, a, b, _ in pii.spans_of(text) if kind == "secret"] == [SECRET]
    assert pii.redacted(text) == f"words {name}[SECRET]' more"


@pytest.mark.parametrize("text", [f"sha1 = {SECRET}", "token = aaaaaaaaaaaaaaaaaaaaaaaa", "the key: internationalisation matters", "token = 1234567890123456", f"token {SECRET}", "key=" + "a1" * 30])
def test_what_is_no_secret(text):
    assert not [s for s in pii.spans_of(text) if s[0] == "secret"]


def test_time_of_assignments_is_linear():
    start = time.perf_counter()
    for text in ("=" * 200_000, "a=" * 100_000, "key: " * 40_000, "=" + "a1b2" * 50_000, ": \t" * 60_000):
        pii.spans_of(text)
    assert time.perf_counter() - start < 20


def test_planted_secrets_are_found(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    planted = [t for t in texts if re.search('token = "[0-9a-f]{40}"', t)]
    assert planted and not [t for t in planted if re.search('token = "[0-9a-f]{40}"', pii.redacted(t))]
