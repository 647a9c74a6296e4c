"""Problems from HTML pages and Markdown folders; plain Python for use inside Arrow functions."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

#: Elements without an end tag, and those after which a line ends.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_LINE = re.compile(r"(?i)<br\s*/?>|</(?:p|li|div|pre)\s*>")


class _Tree(HTMLParser):
    """Text of the elements of interest: (tag, class, parts) in the order they begin."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str, list[str]]] = []
        self.done: list[tuple[str, str, list[str]]] = []

    def handle_starttag(self, tag, attrs):
        node = (tag, dict(attrs).get("class") or "", [])
        self.done.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        if any(t == tag for t, *_ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if data.strip() and not any(t in ("script", "style") for t, *_ in self.open):
            for _, _, parts in self.open:
                parts.append(data.strip())


def html_problem(text: str) -> dict | None:
    """Title of the first h1, else of the page; description of the first div whose class has
    "description", else of the article or body; tags are elements whose class has "tag"."""
    tree = _Tree()
    tree.feed(text)
    tree.close()
    of = lambda test: next((parts for tag, cls, parts in tree.done if test(tag, cls)), None)
    title = of(lambda t, c: t == "h1")
    title = title if title is not None else of(lambda t, c: t == "title")
    if not title or not "".join(title):
        return None
    body = (
        of(lambda t, c: t == "div" and "description" in c)
        or of(lambda t, c: t == "article")
        or of(lambda t, c: t == "body")
        or []
    )
    tags = ["".join(parts) for tag, cls, parts in tree.done if "tag" in cls and "".join(parts)]
    return {"title": "".join(title), "description": "\n".join(body), "difficulty": None, "tags": tags, "examples_raw": [],
            "constraints": [], "solution_code": None, "solution_language": None, "is_premium": False, "extra": None}


def html_to_text(text: str) -> str:
    text = re.sub(r"(?is)<sup>(.*?)</sup>", r"^\1", text)
    text = re.sub(r"<[^>]+>", "", _LINE.sub("\n", text))
    lines = [re.sub(r"[ \t\xa0]+", " ", line).strip() for line in unescape(text).split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


#: Marks, labels and headings of the Markdown pages, in English and Chinese.
PROBLEM_MARK = "<!-- problem:start -->"
_TITLE = re.compile(r"(?m)^#\s+\[(.*?)\]\((.*?)\)\s*$")
_PREFIX = re.compile(r"^(?:(?:LCP|LCS)\s*\d+\.\s*|面试题\s*\d+\s*-?\s*[IVXivx]*\.\s*|剑指\s*Offer(?:\s*II)?\s*\d+\.\s*|\d+(?:\.\d+)*\.\s*)")
_FRONT = re.compile(r"(?s)\A---\n(.*?)\n---\n")
_DESCRIPTION = re.compile(r"(?s)<!--\s*description:start\s*-->(.*?)<!--\s*description:end\s*-->")
_EXAMPLE = re.compile(r'(?s)<pre>(.*?)</pre>|<div class="example-block">(.*?)</div>')
_LABEL = re.compile(r"<strong>(Input|输入|Output|输出|Explanation|解释)[：:]?</strong>")
_LABELS = {"Input": "input", "输入": "input", "Output": "output", "输出": "output", "Explanation": "explanation", "解释": "explanation"}
_LIMITS = re.compile(r"(?s)<strong>(?:Constraints|限制|提示)[：:]?</strong>.*?<ul>(.*?)</ul>")
_ITEM = re.compile(r"(?s)<li>(.*?)</li>")
_FENCE = re.compile(r"(?ms)^####\s+(\S+)\s*\n+```[a-zA-Z0-9]*\n(.*?)```")
LANGUAGES = {"python3": "python", "python": "python", "java": "java", "c++": "cpp", "go": "go", "typescript": "typescript", "javascript": "javascript", "rust": "rust", "c#": "csharp"}
PREFERRED = ("python3", "python", "java", "c++")
PREMIUM = "🔒"


def page_title(text: str) -> tuple[str | None, bool]:
    m = _TITLE.search(text)
    if not m:
        return None, False
    raw = m[1].strip()
    premium = raw.endswith(PREMIUM)
    raw = raw.removesuffix(PREMIUM).strip()
    return _PREFIX.sub("", raw, count=1).strip() or raw, premium


def page_examples(text: str) -> list[dict[str, str]]:
    out = []
    for m in _EXAMPLE.finditer(text):
        block = m[1] or m[2] or ""
        marks, found = list(_LABEL.finditer(block)), {}
        for a, b in zip(marks, [*marks[1:], None]):
            found.setdefault(_LABELS[a[1]], html_to_text(block[a.end() : b.start() if b else None]))
        if "input" in found:
            out.append({"input": found["input"], "output": found.get("output", "")} | ({"explanation": found["explanation"]} if found.get("explanation") else {}))
    return out


def page_solution(text: str) -> tuple[str | None, str | None]:
    """(code, language) of the first solutions section, in the preferred language it has."""
    for heading in ("## Solutions", "## 解法"):
        at = text.find(heading)
        if at >= 0:
            section = re.split(r"<!--\s*solution:end\s*-->", text[at:], maxsplit=1)[0]
            codes: dict[str, str] = {}
            for m in _FENCE.finditer(section):
                codes.setdefault(m[1].lower(), m[2].strip())
            if codes:
                chosen = next((p for p in PREFERRED if p in codes), next(iter(codes)))
                return codes[chosen], LANGUAGES.get(chosen, chosen)
            return None, None
    return None, None


def front_matter(text: str) -> dict:
    m = _FRONT.search(text)
    if not m:
        return {}
    try:
        import yaml

        v = yaml.safe_load(m[1])
    except Exception:  # malformed front matter is no front matter
        return {}
    return v if isinstance(v, dict) else {}


def markdown_problem(text: str) -> dict | None:
    if PROBLEM_MARK not in text:
        return None
    title, premium = page_title(text)
    if not title:
        return None
    front = front_matter(text)
    m = _DESCRIPTION.search(text)
    body = m[1] if m else ""
    limits = _LIMITS.search(body)
    code, language = page_solution(text)
    tags = front.get("tags")
    return {
        "title": title,
        "description": html_to_text(body),
        "difficulty": str(front["difficulty"]) if front.get("difficulty") is not None else None,
        "tags": [str(t) for t in tags] if isinstance(tags, list) else [],
        "examples_raw": page_examples(body),
        "constraints": [html_to_text(x) for x in _ITEM.findall(limits[1])] if limits else [],
        "solution_code": code,
        "solution_language": language,
        "is_premium": premium,
        "extra": None,
    }
