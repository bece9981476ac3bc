"""A small corpus with the awkward cases, and helpers."""

import hashlib
import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "doc long, pos string, name string, rest string, lines string, gone string, score string, kind string")

_rng = random.Random(5)
_SYL = ["the", "an", "tion", "er", "ing", "ou", "ré", "çè", "öß", "st", "Wh", "ble", "ñas", "日本"]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(_SYL) for _ in range(r.randint(1, 4))) + r.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))


A, B, C = prose(120, 1), prose(90, 2), prose(60, 3)
PASSAGE = prose(70, 4)
TEXTS = [
    A, A, A.upper(), B, None, "", None, B + "\n" + C, C, A[: len(A) // 2] + " changed here " + A[len(A) // 2:],
    prose(30, 6) + "\n" + PASSAGE + "\n" + prose(30, 7), PASSAGE, prose(20, 8) + PASSAGE[10:200] + prose(10, 9),
    "a" * 500, "a" * 49, "a" * 50, "ab" * 200, "x", " ", "\n", "\n\n", "one two", "one\ttwo", "one  two three four",
    "A shared heading line\nown text one\n  a Shared HEADING line\t\nshort\nshort", "short\na shared heading line\nown text two", "a shared heading line",
    "ÉCOLE and école line long\nécole AND école line long", "École and école line long",
    "mail john.doe+x@example.org or a@b.c@d.ef, a_b@x-y.co_m@q.rs; 10.0.0.255 and 1.2.3.4.5.6.7.8 not 256.1.1.1 007.8.9.0001 1..2.3.4",
    "card 4111 1111 1111 1111 bad 4111 1111 1111 1112, 5500-0000-0000-0004 and 4111 1111 1111 1111 2; call +49 (0)30 1234-567 or +1 2 +99999999999999999999 +5 5555555.",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 not DE00 3704 0044 0532 0130 00; ssn 123-45-6789 and 987-65-4321 ü ÄÖ 日本 ssn: 078-05-1120",
    "9" * 300, "+" + "1" * 300, "a." * 400 + "@", "Released under the MIT License, Apache License, Version 2.0 or CC-BY-NC 4.0. cc by nc cc BY nc",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")",
    "Redistribution and use in source and binary forms, with or without changes, are permitted provided that the following conditions are met",
    "under the mit license under the mit", "you idiot moron clown", "<|endoftext|> it's we'll x▁y ▁ \r\n\t  end  ", "tab\tand  double  spaces \n lead",
    prose(5000, 10), "z" * 70000, prose(3, 11) + "\x00 nul \x7f", "🙂" * 40 + " emoji 🙂 x",
]


def rows(texts=None):
    out = [(i * 3 + 1, t, ["en", "fr", None][i % 3], "src0" if i % 3 else None, None if t is None else len(t),
            7, "p", None, "r", "l", "g", "s", "k") for i, t in enumerate(TEXTS if texts is None else texts)]
    return out


def frame(spark, texts=None, repeat=False, with_null_id=False):
    data = rows(texts)
    if repeat:
        data = data + data[:6]
    if with_null_id:
        data = data + [(None,) + r[1:] for r in data[:3]]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
