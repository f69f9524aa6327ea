"""Licence scan by sentence rules (DataFrame functions only).

A text becomes a stream of normalised words with marks where sentences and lines
end. Known licence sentences are looked for from mark to mark, over the ends of
lines, so a wrapped or commented one is found too. The identifiers found, in
order, are matched against licence rules, which are ordered identifier sequences. A sequence is written as a
string of one letter per sentence, so that a rule is a substring; at each place
the longest rule wins, and rules don't overlap. Sentences, with one wording or
several, and rules are tables given to the operator; ``SENTENCES`` and ``RULES`` are
those of common licences and their ``SPDX-License-Identifier`` lines (one licence
each; expressions of several are not read).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, quoted, without

#: Known licence sentences by identifier (one letter each); a tuple holds wordings of one.
SENTENCES: dict[str, str | tuple[str, ...]] = {
    "A": "Licensed under the Apache License, Version 2.0",
    "B": "you may not use this file except in compliance with the License",
    "C": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
         "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "D": "See the License for the specific language governing permissions and limitations under the License",
    "E": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "F": ("Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License"),
    "G": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
         "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
         "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
         "subject to the following conditions",
    "H": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "I": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
         "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "J": "This work is licensed under the GNU General Public License, version 3",
    "K": "This program is free software",
    "L": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
         "either version 3 of the License, or (at your option) any later version",
    "M": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "N": "either version 2 of the License, or (at your option) any later version",
    "O": "Licensed under CC BY-NC 4.0",
    "P": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "Q": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "R": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "S": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
         "documentation and/or other materials provided with the distribution",
    "T": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
         "software without specific prior written permission",
    "U": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "V": "This is free and unencumbered software released into the public domain",
    "W": "All rights reserved",
    "X": "This library is free software",
    "Y": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "Z": "either version 2.1 of the License, or (at your option) any later version",
    "a": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software "
         "Foundation, either version 3 of the License, or (at your option) any later version",
    "b": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software "
         "Foundation, either version 3 of the License, or (at your option) any later version",
    "c": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
          "above copyright notice and this permission notice appear in all copies",
          "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the "
          "above copyright notice and this permission notice appear in all copies"),
    "d": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
         "MERCHANTABILITY AND FITNESS",
    "e": "Distributed under the Boost Software License, Version 1.0",
    "f": "Boost Software License - Version 1.0 - August 17th, 2003",
    "g": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the "
         "public domain worldwide",
}
#: Rules, a licence and the sentences that must follow one another.
RULES = [
    ("Apache-2.0", "EBCD"), ("Apache-2.0", "EB"), ("Apache-2.0", "E"), ("Apache-2.0", "A"),
    ("MIT", "GHI"), ("MIT", "GH"), ("MIT", "F"),
    ("GPL-3.0-or-later", "KL"), ("GPL-2.0-or-later", "KMN"), ("GPL-3.0", "J"),
    ("BSD-3-Clause", "QRST"), ("BSD-2-Clause", "QRS"),
    ("CC-BY-NC-4.0", "O"), ("CC-BY-4.0", "P"), ("MPL-2.0", "U"), ("Unlicense", "V"), ("Proprietary", "W"),
    ("LGPL-2.1-or-later", "XYZ"), ("LGPL-3.0-or-later", "Xa"), ("LGPL-3.0-or-later", "Ka"), ("AGPL-3.0-or-later", "Kb"),
    ("ISC", "cd"), ("ISC", "c"), ("BSL-1.0", "e"), ("BSL-1.0", "f"), ("CC0-1.0", "g"),
]
#: Letters of the identifier lines, "SPDX-License-Identifier: MIT".
IDENTIFIER_LINES = dict(zip("hijklmnopqrstuvw", sorted({name for name, _ in RULES} - {"GPL-3.0", "Proprietary"}), strict=True))
SENTENCES |= {letter: f"SPDX-License-Identifier: {name}" for letter, name in IDENTIFIER_LINES.items()}
RULES += [(name, letter) for letter, name in IDENTIFIER_LINES.items()]
#: Every known sentence has one of these, so a text without any has none.
ANCHORS = ("licen", "rights", "permi", "software", "redistribut", "copyright")

SPACE = "[ \\t\\n\\x0B\\f\\r]"
#: Mark of a sentence's end among normalised words.
STOP = "\x01"


def normalise(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def rules_by_length(rules: Iterable[tuple[str, str]] = RULES) -> list[tuple[str, str]]:
    return sorted(rules, key=lambda r: (-len(r[1]), r[1]))


def marked(sentence: str) -> str:
    """A known sentence's words, with ``STOP`` where the sign of an end is inside it ("v. 2.0")."""
    return STOP.join(normalise(part) for part in re.split("[.!?;:]+" + SPACE, sentence))


def wordings(sentences: Mapping[str, str | Sequence[str]]) -> dict[str, str]:
    """The identifier of each wording (its marked words), the longest first."""
    known = {marked(s): letter for letter, some in sentences.items() for s in ([some] if isinstance(some, str) else some)}
    return dict(sorted(known.items(), key=lambda k: (-len(k[0]), k[0])))


def checked(sentences: Mapping[str, str | Sequence[str]], rules: Iterable[tuple[str, str]], anchors: Iterable[str]) -> None:
    """Tables that could not find what they name are an error."""
    bad = [letter for letter in sentences if not re.fullmatch("[A-Za-z0-9]", letter)]
    bad += [seq for _, seq in rules if not seq or not set(seq) <= set(sentences)]
    bad += [s for s in wordings(sentences) if not s.strip() or not any(a in s for a in anchors)]
    if bad or len({seq for _, seq in rules}) < len(list(rules)):
        raise ValueError(f"identifiers are one letter, rules are distinct and of known letters, every sentence has an anchor: {bad}")


def sentence_pattern(sentences: Mapping[str, str | Sequence[str]] = SENTENCES) -> str:
    """Any known sentence from mark to mark, the longest first; lines may end between its words."""
    return f"(?<=[\n{STOP}])(?:" + "|".join(b.replace(" ", "[ \n]") for b in wordings(sentences)) + f")(?=[\n{STOP}])"


def marked_words(text: Column) -> Column:
    """The normalised words. ``STOP`` stands for a sign of a sentence's end before
    white space, for lines without words and for the end of a line with an
    SPDX identifier, a line feed for any other end of a line, unless the next goes
    on in lower case. Signs that make a line a comment
    are no words."""
    lines = F.regexp_replace(F.concat(F.translate(text, STOP, " "), F.lit("\n")), "(SPDX-License-Identifier:[^\\n]*)\\n", f"$1{STOP}\n")
    joined = F.regexp_replace(lines, "\\n[ \\t]*([a-z(\"])", " $1")
    stopped = F.regexp_replace(joined, f"[.!?;:]+{SPACE}", STOP)
    stopped = F.regexp_replace(stopped, f"\\n[^A-Za-z0-9\\n{STOP}]*(?=\\n)", STOP)
    words = F.regexp_replace(ascii_lower(stopped), f"[^a-z0-9\\n{STOP}]+", " ")
    words = F.regexp_replace(F.concat(F.lit(STOP), words, F.lit(STOP)), f"[ \\n]*{STOP}[ \\n{STOP}]*", STOP)
    return F.regexp_replace(words, " ?\\n[ \\n]*", "\n")


def sentence_ids(text: Column, sentences: Mapping[str, str | Sequence[str]] = SENTENCES, anchors: Iterable[str] = ANCHORS) -> Column:
    """The letters of the known sentences, in order."""
    known = F.create_map(*[F.lit(x) for pair in wordings(sentences).items() for x in pair])
    lower = ascii_lower(text)
    hinted = F.lit(False)
    for anchor in anchors:
        hinted = hinted | lower.contains(anchor)
    found = F.regexp_extract_all(marked_words(text), F.lit(sentence_pattern(sentences)), F.lit(0))
    letters = F.array_join(F.transform(found, lambda s: F.try_element_at(known, F.translate(s, "\n", " "))), "")
    return F.when(hinted, letters).otherwise(F.lit(""))


def matched_rules(letters: Column, rules: Iterable[tuple[str, str]] = RULES) -> Column:
    """The rules' sequences found, from the left, the longest first at each place."""
    return F.regexp_extract_all(letters, F.lit("(" + "|".join(seq for _, seq in rules_by_length(rules)) + ")"), F.lit(1))


def scan_licenses(docs: DataFrame, text: str = "text", sentences: Mapping[str, str | Sequence[str]] = SENTENCES,
                  rules: Sequence[tuple[str, str]] = RULES, anchors: Sequence[str] = ANCHORS) -> DataFrame:
    """Every row of ``docs`` with ``sentence_ids`` (a letter per known sentence),
    ``rule_matches`` (the sequences matched, in order) and ``licenses`` (distinct, in
    order of names). ``sentences``: wordings by letter; ``rules``: licences and the letters
    that must follow one another; ``anchors``: every sentence has one of these. A null
    or empty text has none. Repeated rows are alike. Input columns named like a
    result column are replaced."""
    checked(sentences, rules, anchors)
    keep = without(docs, ["sentence_ids", "rule_matches", "licenses", "__letters"])
    names = F.create_map(*[F.lit(x) for name, seq in rules for x in (seq, name)])
    letters = sentence_ids(F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")), sentences, anchors)
    return (docs.select(*[F.col(quoted(c)) for c in keep], letters.alias("sentence_ids"))
            .withColumn("rule_matches", matched_rules(F.col("sentence_ids"), rules))
            .withColumn("licenses", F.array_sort(F.array_distinct(F.transform("rule_matches", lambda m: F.try_element_at(names, m))))))


def brute_force(text: str | None) -> tuple[str, list[str], list[str]]:
    """The same by plain Python (for tests)."""
    known = {tuple(re.findall("[a-z0-9]+|\x01", words)): letter for words, letter in wordings(SENTENCES).items()}
    lines = re.sub("(SPDX-License-Identifier:[^\n]*)\n", "\\1\x01\n", (text or "").replace("\x01", " ") + "\n")
    joined = re.sub("\n[ \t]*([a-z(\"])", r" \1", lines)
    words: list[str] = ["\x01"]
    for sentence in re.split(r"\x01|[.!?;:]+[ \t\n\x0B\f\r]", joined):
        for line in sentence.split("\n"):
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
            own = re.findall("[a-z0-9]+", lowered)
            words += [*own, "\n"] if own else ["\x01"]
        words.append("\x01")
    ends = [i for i, w in enumerate(words) if not w.isalnum()]
    letters, matches, done = "", [], 0
    for start in ends:
        best = (0, "", 0)
        for sentence, letter in known.items() if start >= done else ():
            at, left = start + 1, list(sentence)
            while left and at < len(words) and (words[at] in (left[0], "\n") or left[0] == "\x01" and not words[at].isalnum()):
                if left[0] == "\x01" and not words[at].isalnum():
                    run = at
                    while not words[run].isalnum() and run + 1 < len(words):
                        run += 1
                    if "\x01" not in words[at:run]:
                        break
                    at, left = run, left[1:]
                    continue
                left = left[words[at] == left[0] :]
                at += 1
            if not left and at < len(words) and not words[at].isalnum():
                best = max(best, (len(sentence), letter, at))
        letters += best[1]
        done = max(done, best[2])
    at = 0
    while at < len(letters):
        seq = next((s for _, s in rules_by_length() if letters.startswith(s, at)), None)
        at += len(seq) if seq else 1
        matches += [seq] if seq else []
    return letters, matches, sorted({n for n, s in RULES if s in matches})
