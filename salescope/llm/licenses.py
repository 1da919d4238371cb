"""License scans: an Aho-Corasick automaton over words finds notices and identifier tags; expressions are evaluated.

One automaton holds all phrases, word by word. A text walks through it once; words of no phrase lead back to its root,
so that only runs of phrase words are looked at. Where the identifier tag stands, the expression after it is parsed by
the shunting-yard algorithm ("with" binds closest, then "and", then "or"; parentheses as usual) and evaluated: how freely
the text may be used is the least of what "and" joins, the most of what "or" offers, and an exception softens what it is
given "with".

Contract: a null or empty text has no words and no labels; texts are read whole, one at a time; an expression ends where
it is no longer well formed, and one that names nothing is ignored; repeated rows each get their result; extra columns
stay out of the way; an empty table gives no rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from salescope.llm.common import ship, text_of

ship(__name__)

# The base phrases and labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notices, the tag, and how freely texts under a label may be used; unknown identifiers count as UNKNOWN.
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAG = "spdx license identifier"
FREEDOM = {
    "public-domain": 1.0, "mit": 1.0, "isc": 1.0, "bsd": 1.0, "apache": 1.0, "bsl": 1.0, "cc-by": 0.9, "mpl": 0.6,
    "epl": 0.6, "lgpl": 0.5, "gpl": 0.3, "agpl": 0.2, "reserved": 0.0,
}
UNKNOWN, EXCEPTION = 0.4, 0.6
# Beginnings of public licence identifiers and the label each stands for, longer ones first.
IDENTIFIERS = {
    "agpl": "agpl", "apache": "apache", "bsd": "bsd", "bsl": "bsl", "cc-by": "cc-by", "cc0": "public-domain",
    "epl": "epl", "gpl": "gpl", "isc": "isc", "lgpl": "lgpl", "mit": "mit", "mpl": "mpl", "unlicense": "public-domain",
}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

# A-Z in lower case, and all ASCII that is no letter or digit as a blank; bytes beyond ASCII are parts of words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_TAG_LINE = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[ \t]*(?:([()])|([0-9A-Za-z][0-9A-Za-z.+:-]*))")


class Automaton:
    """Aho-Corasick over words: ``find`` yields (start word, phrase) for each place of each phrase."""

    def __init__(self, phrases: list[str]):
        self.next, self.fail, self.ends = [{}], [0], [[]]
        self.words = set()
        for phrase in phrases:
            state, words = 0, phrase.encode().split()
            for word in words:
                self.words.add(word)
                if word not in self.next[state]:
                    self.next.append({})
                    self.fail.append(0)
                    self.ends.append([])
                    self.next[state][word] = len(self.next) - 1
                state = self.next[state][word]
            self.ends[state].append((len(words), phrase))
        # Breadth first: the state to fall back to is the longest proper suffix that begins a phrase.
        queue = list(self.next[0].values())
        for state in queue:
            for word, child in self.next[state].items():
                back = self.fail[state]
                while back and word not in self.next[back]:
                    back = self.fail[back]
                self.fail[child] = self.next[back].get(word, 0)
                self.ends[child] = self.ends[child] + self.ends[self.fail[child]]
                queue.append(child)

    def find(self, words: list[bytes]):
        known, state, last = self.words, 0, -2
        for i in [i for i, word in enumerate(words) if word in known]:
            if i != last + 1:
                state = 0
            last, word = i, words[i]
            while state and word not in self.next[state]:
                state = self.fail[state]
            state = self.next[state].get(word, 0)
            for length, phrase in self.ends[state]:
                yield i - length + 1, phrase


def in_postfix(expression: str) -> list[str]:
    """The identifiers and operators of an expression, operators after what they join. It ends where it breaks."""
    output, operators, at, operand = [], [], 0, True
    while match := _TOKEN.match(expression, at):
        paren, word = match.groups()
        operator = (word or "").lower() if (word or "").lower() in PRECEDENCE else None
        if operand != (paren == "(" or (word is not None and operator is None)):
            break
        if paren == "(":
            operators.append(paren)
        elif paren == ")":
            if "(" not in operators:
                break
            while (top := operators.pop()) != "(":
                output.append(top)
        elif operator:
            while operators and operators[-1] != "(" and PRECEDENCE[operators[-1]] >= PRECEDENCE[operator]:
                output.append(operators.pop())
            operators.append(operator)
            operand = True
        else:
            output.append(word)
            operand = False
        at = match.end()
    # What waits for an operand that never came is dropped; open parentheses are closed.
    if operand and operators:
        while operators and operators[-1] == "(":
            operators.pop()
        if operators:
            operators.pop()
    return output + [op for op in reversed(operators) if op != "("]


def label_of(identifier: str) -> str:
    low = identifier.lower()
    found = [b for b in IDENTIFIERS if low.startswith(b)]
    return IDENTIFIERS[max(found, key=len)] if found else low


def evaluate(expression: str) -> tuple[set[str], float] | None:
    """The labels that an expression names and how freely it lets use the text; None if it names nothing."""
    stack = []
    for token in in_postfix(expression):
        if token not in PRECEDENCE:
            label = label_of(token)
            stack.append(({label}, FREEDOM.get(label, UNKNOWN)))
            continue
        if len(stack) < 2:
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            # The right side names an exception, which is no licence of its own.
            stack.append((left[0], max(left[1], EXCEPTION)))
        else:
            stack.append((left[0] | right[0], (min if token == "and" else max)(left[1], right[1])))
    return stack[-1] if stack else None


def scan_text(text: str, automaton: Automaton) -> dict:
    """Words, places of base phrases, and all labels of one text."""
    words = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
    places, labels, freedom, tagged = [], set(), 1.0, False
    for start, phrase in automaton.find(words):
        if phrase == TAG:
            tagged = True
            continue
        label = BASE_PHRASES.get(phrase) or MORE_PHRASES[phrase]
        if phrase in BASE_PHRASES:
            places.append((start, label))
        labels.add(label)
        freedom = min(freedom, FREEDOM[label])
    for match in _TAG_LINE.finditer(text) if tagged else ():
        if found := evaluate(match[1]):
            labels |= found[0]
            freedom = min(freedom, found[1])
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min((s for s, _ in places), default=None),
        "last_word": max((s for s, _ in places), default=None),
        "base_labels": ",".join(sorted({label for _, label in places})),
        "labels": ",".join(sorted(labels)),
        "score": freedom if labels else 0.0,
    }


RESULT = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each document.

    ``score`` is how freely the text may be used by the strictest licence found, 0 where none is found.
    """
    phrases = [*BASE_PHRASES, *MORE_PHRASES, TAG]
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [part.split()[0] for part in RESULT.split(", ")]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def of_batches(batches):
        automaton = Automaton(phrases)
        for batch in batches:
            found = [scan_text(text.as_py(), automaton) for text in batch.column(1)]
            columns = [pa.array([f[n] for f in found], t) for n, t in zip(names, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(of_batches, f"doc_id {kind}, {RESULT}")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels and notices of all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
