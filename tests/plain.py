"""The cleaning rules restated in plain Python."""

import re

from quernstone.functions.text import DOC_TAGS


def drop_to_end(text, markers):
    for_each = []
    for line in text.split("\n"):
        cuts = [line.find(m) for m in markers if m in line]
        for_each.append(line[: min(cuts)] if cuts else line)
    return "\n".join(for_each)


def plain_doc(doc):
    if not doc:
        return ""
    head = drop_to_end(drop_to_end(doc.split("\n\n")[0], DOC_TAGS), [">>>"])
    return " ".join(re.sub(r"http\S+", "", head).split())


def scan_comments(code):
    """Literal by literal: a quote opens a literal when an unescaped twin follows on the line."""
    out, at = [], 0
    while at < len(code):
        char = code[at]
        if char in "\"'":
            end = code.find("\n", at)
            line_end = len(code) if end < 0 else end
            close = next((i for i in range(at + 1, line_end) if code[i] == char and code[i - 1] != "\\"), None)
            if close is not None:
                out.append(code[at: close + 1])
                at = close + 1
                continue
        if char == "#":
            end = code.find("\n", at)
            at = len(code) if end < 0 else end
            continue
        out.append(char)
        at += 1
    return "".join(out)


def plain_code(code):
    if not code:
        return ""
    starts = [(code.find(q), q) for q in ('"""', "'''")]
    for start, quote in sorted(s for s in starts if s[0] >= 0):
        end = code.find(quote, start + 3)
        if end >= 0:
            code = code[:start] + code[end + 3:]
            break
    lines = [line for line in scan_comments(code).split("\n") if line.strip()]
    return "\n".join(lines).strip()
