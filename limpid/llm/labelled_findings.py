"""Labelled findings of a secret scanner, made by rule, for training the false-positive filter."""

from __future__ import annotations

import random
import string

SYLLABLES = "an the er on in th re at ou ti es or en st nd he ea ing ed tion ly que de la men to ra mi ko".split()
LOWER, UPPER, DIGITS, HEX = string.ascii_lowercase, string.ascii_uppercase, string.digits, "0123456789abcdef"
MIXED = string.ascii_letters + string.digits


def _secret(r: random.Random) -> tuple[str, str, str]:
    """What stands before, the secret, what stands behind."""
    def some(letters: str, low: int, high: int) -> str:
        return "".join(r.choices(letters, k=r.randint(low, high)))

    def words(low: int, high: int) -> list[str]:
        return ["".join(r.choices(SYLLABLES, k=r.randint(1, 3))) for _ in range(r.randint(low, high))]

    key = r.choice(["password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "auth_token",
                    "client_secret", "private_key", "SECRET_KEY", "API_TOKEN", "db_password", "DB_PASS", "signing_key", "passphrase"])
    equals, quote = r.choice(["=", " = ", ": ", ":"]), r.choice(["", "", '"', "'"])
    return r.choice([
        lambda: ("", r.choice(["AKIA", "ASIA"]) + some(UPPER + "234567", 16, 16), ""),
        lambda: ("", r.choice(["ghp_", "gho_", "github_pat_"]) + some(MIXED, 36, 40), ""),
        lambda: ("", r.choice(["sk-", "sk_live_", "rk_live_", "xoxb-", "glpat-", "AIza", "npm_"]) + some(MIXED + "_-", 20, 48), ""),
        lambda: ("", ".".join(["eyJ" + some(MIXED, 15, 40), "eyJ" + some(MIXED, 20, 80), some(MIXED + "_-", 30, 43)]), ""),
        lambda: (key + equals + quote, some(HEX, r.choice([12, 16, 24, 32, 40, 64]), 64)[:r.choice([10, 14, 16, 20, 32, 40, 64])], quote),
        lambda: (key + equals + quote, some(MIXED, 8, 48), quote),
        lambda: (key + equals + quote, some(MIXED + "!@$%^&*_-+", 8, 32), quote),
        lambda: (key + equals + quote, some(MIXED + "+/", 24, 64) + r.choice(["", "=", "=="]), quote),
        lambda: ("Bearer ", some(MIXED + "_-", 24, 60), ""),
        lambda: ("postgres://user:", some(MIXED, 8, 20), "@host/db"),
        lambda: (key + equals + '"', some(MIXED + "!#%&", 4, 9) + " " + some(MIXED + "!#%&", 4, 9), '"'),
        lambda: (r.choice(["passphrase", "pass_phrase", "PASSPHRASE"]) + equals + '"', " ".join(words(4, 7)), '"'),
        lambda: ("", _frame(r, r.choice(["RSA PRIVATE KEY", "PRIVATE KEY", "OPENSSH PRIVATE KEY", "EC PRIVATE KEY"])), "")])()


def _frame(r: random.Random, label: str) -> str:
    lines = ["".join(r.choices(MIXED + "+/", k=64)) for _ in range(r.randint(3, 20))]
    return "\n".join([f"-----BEGIN {label}-----", *lines, f"-----END {label}-----"])


def _harmless(r: random.Random) -> tuple[str, str, str]:
    def some(letters: str, low: int, high: int) -> str:
        return "".join(r.choices(letters, k=r.randint(low, high)))

    def word(low: int, high: int) -> str:
        return "".join(r.choices(SYLLABLES, k=r.randint(low, high)))

    key = r.choice(["password", "token", "secret", "api_key", "pwd"])
    return r.choice([
        lambda: ("", word(6, 14), r.choice(["", ",", "."])),
        lambda: ("", word(6, 14).capitalize(), r.choice(["", ",", "."])),
        lambda: ("", word(6, 14).upper(), r.choice(["", "!!", "."])),
        lambda: (r.choice(["commit ", "revision ", "sha1 ", "tree ", "parent "]), some(HEX, 40, 40), ""),
        lambda: (r.choice(["md5: ", "checksum: ", "sha256=", "digest: ", "etag: "]), some(HEX, r.choice([32, 40, 64]), 64)[:r.choice([32, 64])], ""),
        lambda: (r.choice(["id ", "uuid ", "request ", ""]), "-".join(some(HEX, n, n) for n in (8, 4, 4, 4, 12)), ""),
        lambda: ("", "/".join(["", *(word(1, 4) for _ in range(r.randint(3, 6)))]), ".py"),
        lambda: ("https://www." + word(2, 3) + ".example.com", "/" + "/".join(word(1, 4) for _ in range(4)) + "-" + some(DIGITS, 2, 6), ""),
        lambda: ("", some(DIGITS, 16, 19), ""),
        lambda: ("", word(5, 9) + r.choice([".", "_", ""]) + some(DIGITS, 1, 4), "@mail" + some(DIGITS, 0, 2) + ".example.com"),
        lambda: ("", "4" + some(DIGITS, 15, 15), ""),
        lambda: (key + r.choice(["=", ": "]), r.choice(["changeme", "password", "your_password_here", "xxxxxxxxxxxx", "********",
                                                     "<your-token>", "example_token", "placeholder", "REPLACE_ME", "null", "undefined", "$PASSWORD",
                                                     "${TOKEN}", "process.env.TOKEN", "os.environ", "getpass()", word(2, 5)]), ""),
        lambda: (key + r.choice([": ", " = "]), word(2, 6), ""),
        lambda: ("", "_".join(word(1, 3) for _ in range(4)).upper(), ""),
        lambda: ("", word(1, 2) + "".join(word(1, 3).capitalize() for _ in range(4)), "("),
        lambda: ("", "-".join(word(1, 3) for _ in range(5)), ""),
        lambda: ("", r.choice("=-_+") * r.randint(16, 60), ""),
        lambda: ("", r.choice("aAxX01") * r.randint(16, 40), ""),
        lambda: (f"data:{r.choice(['image/png', 'image/gif', 'font/woff2', 'text/css'])};base64,", some(MIXED + "+/", 24, 900) + r.choice(["", "=", "=="]), ")"),
        lambda: (f"data:{r.choice(['image/jpeg', 'application/pdf'])};base64,", some(MIXED + "+/", 300, 1500), '"'),
        lambda: (r.choice(['integrity="', '"integrity": "', ""]), f"sha{r.choice([256, 384, 512])}-" + some(MIXED + "+/", 43, 86) + r.choice(["", "=", "=="]), '"'),
        lambda: (r.choice(["ssh-rsa ", "ssh-ed25519 "]), "AAAA" + some(MIXED + "+/", 64, 370), " user@host"),
        lambda: ("", _frame(r, r.choice(["CERTIFICATE", "PUBLIC KEY", "CERTIFICATE REQUEST"])), ""),
        lambda: (r.choice(["index ", "fingerprint: ", "hash="]), some(HEX, 16, 40), ""),
        lambda: ("", word(1, 3) + "." + some(HEX, 8, 20) + r.choice([".chunk.js", ".css", ".bundle.js"]), ""),
        lambda: (key + r.choice([": ", " = "]) + '"', " ".join([r.choice(["enter", "your", "please", "the", "must be"]), word(1, 3), word(1, 3), key]), '"'),
        lambda: (key + r.choice([": ", "="]) + '"', " ".join(word(1, 3) for _ in range(5)) + ".", '"')])()


def findings(count: int, seed: int = 3) -> list[tuple[str, int, int, bool]]:
    """(text, start and end of the value, is a secret), half of them secrets."""
    r, out = random.Random(seed), []
    for n in range(count):
        before, value, behind = (_secret if n % 2 else _harmless)(r)
        words = ["".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(12)]
        start = " ".join(words[:6]) + r.choice([" ", " ", "\n"]) + before
        out.append((start + value + behind + " " + " ".join(words[6:]), len(start), len(start) + len(value), bool(n % 2)))
    return out
