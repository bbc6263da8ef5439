"""The own text of articles in typesetting markup: paragraphs of plain words.

Comments, disabled blocks, bibliographies, formulas, tables, figures and commands go; own macros are written out;
accents are folded, so that \\'e, é and e are one letter.
"""

from __future__ import annotations

import re
import unicodedata

_COMMENT = re.compile(r"(?<!\\)%[^\n]*")
_DISABLED = re.compile(r"\\begin\{comment\}.*?(?:\\end\{comment\}|\Z)|\\if(?:false|0)\b.*?(?:\\fi\b|\Z)", re.DOTALL)
_REFERENCES = re.compile(r"\\begin\{thebibliography\}.*?(?:\\end\{thebibliography\}|\Z)|\\section\*?\{(?:References|Bibliography|Literatur|R\\?'?ef'?erences|Referencias)\}.*\Z", re.DOTALL)
_DEFINED = re.compile(r"\\(?:(?:re)?newcommand\*?\s*\{?|def\s*)\\([A-Za-z]+)\}?\s*(\[\d\])?\s*\{((?:[^{}]|\{[^{}]*\})*)\}")
_NOT_TEXT = re.compile(
    r"\\begin\{(equation|align|displaymath|gather|eqnarray|multline|math|tabular|table|figure|tikzpicture|verbatim|lstlisting|filecontents)(\*?)\}.*?(?:\\end\{\1\2\}|\Z)"
    r"|\$\$.*?\$\$|\$[^$\n]*\$|\\\[.*?\\\]|\\\(.*?\\\)",
    re.DOTALL,
)
_DROPPED = re.compile(
    r"\\(?:cite|parencite|textcite|ref|label|eqref|pageref|autoref|input|include|subfile|includegraphics|bibliography|bibliographystyle|title|author|date|keywords|todo|usepackage|documentclass|documentstyle|DeclareMathOperator|url|footnotemark|caption)[a-z]*\*?"
    r"(?:\[[^\]]*\])*(?:\s*\{(?:[^{}]|\{[^{}]*\})*\})*"
)
_BREAK = re.compile(r"\\(?:sub)*(?:section|paragraph|chapter)\*?\s*\{(?:[^{}]|\{[^{}]*\})*\}|\\(?:begin|end)\{[^}]*\}|\\(?:item|par|maketitle|newpage|clearpage)\b")
_ACCENT = re.compile(r"\\(?:[\"'`^~=.]|[cuvH](?=[\s{]))\s*\{?\\?([A-Za-z])\}?")
_COMMAND = re.compile(r"\\[A-Za-z@]+\*?\s?|\\.")
_PARTED = re.compile(r"\n[ \t\r]*\n\s*")
_WORD = re.compile(r"[^\W\d_]{3,}")


def _expanded(body: str, macros: dict[str, str]) -> str:
    pattern = re.compile(r"\\(" + "|".join(sorted(map(re.escape, macros), key=len, reverse=True)) + r")(?![A-Za-z])(?:\{\}|\\ )?")
    return pattern.sub(lambda m: macros[m[1]] + " ", body)


def own_paragraphs(text: str | None) -> list[list[str]]:
    """The words of three letters or more of each paragraph of the article's own text, in lower case without accents."""
    if not text:
        return []
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if "%" in text:
        text = _COMMENT.sub("", text)
    start = text.find("\\begin{document}")
    head, body = (text[:start], text[start + 16 :]) if start >= 0 else (text, text)
    end = body.find("\\end{document}")
    if end >= 0:
        body = body[:end]
    if "\\if" in body or "{comment}" in body:
        body = _DISABLED.sub("\n\n", body)
    if "iblio" in body or "efer" in body or "iteratur" in body:
        body = _REFERENCES.sub("\n\n", body)
    if "\\def" in head or "newcommand" in head:
        macros = {m[1]: m[3] for m in _DEFINED.finditer(head) if not m[2]}
        if start < 0:
            body = _DEFINED.sub(" ", body)
        if macros:
            body = _expanded(body, macros)
    if "\\" in body or "$" in body:
        body = _NOT_TEXT.sub(" ", body)
        body = _DROPPED.sub(" ", body)
        body = _BREAK.sub("\n\n", body)
        body = _ACCENT.sub(r"\1", body)
        body = _COMMAND.sub(" ", body)
    body = body.lower()
    if not body.isascii():
        body = unicodedata.normalize("NFKD", body)
        body = "".join(c for c in body if not unicodedata.combining(c)) if not body.isascii() else body
    out = []
    for part in _PARTED.split(body):
        words = _WORD.findall(part)
        if words:
            out.append(words)
    return out
