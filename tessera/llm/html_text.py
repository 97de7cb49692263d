"""HTML extraction: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at block-level tags. A block is described by its
word count and link density, by those of its neighbours, and by where it stands
(in an article or main element; in an element that is furniture by tag or role, or
a comment area). Names and forms are weaker marks, as whole pages stand in forms and
in elements called header-fixed: there the share of the page's plain words outside the
element is the feature. A small classification tree, grown here from the labelled table below,
says which blocks are main text.

Defined results: null or empty html, and pages without main text, give an empty
text; tags that are never closed end with the page; rows are judged one by one.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame

from tessera.llm.common import with_result

# Fixed values of HTML: elements whose content is not text, elements without an
# end tag, and elements that stand inside a line.
SILENT = frozenset("script style title textarea template noscript iframe svg select option button object "
                   "canvas audio video annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr "
                   "math semantics maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
                   "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtext munder munderover".split())
SPACE = frozenset("br mtr mlabeledtr mtd".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements whose id is the anchor of a place in the text.
ANCHORS = frozenset("section p li dt dd tr td th figure pre blockquote".split())
IMPLIED_END = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]),
               "dt": frozenset(["dd", "dt"]), "tr": frozenset(["tr", "td", "th"]),
               "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"])}
# What an implied end does not reach across.
SCOPE = frozenset("article main section div body table ul ol dl nav aside footer header form blockquote".split())

# What marks furniture.
FURNITURE_TAGS = frozenset("nav aside footer dialog menu".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu "
                            "menubar toolbar".split())
FURNITURE_NAMES = frozenset(
    "cookie cookies consent gdpr notice notification banner alert popup modal overlay newsletter subscribe signup "
    "paywall disclaimer menu nav navbar navigation breadcrumb breadcrumbs pagination pager toc topbar masthead "
    "footer header share sharing social login search form toolbar".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus replies reply respond discussion".split())
# Words that name a comment area only as the whole name.
COMMENT_AREAS = frozenset("user-feedback reader-feedback responses user-reviews reader-letters".split())
# Furniture that holds articles, which are not the page's own.
TEASER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored promo promoted "
    "promotion sidebar aside rail widget related recommended recommendations".split())
# A name that tells of a layout with furniture, or the heading of an article, is none itself.
LAYOUT_NAMES = frozenset("with without has no".split())
ARTICLE_NAMES = frozenset("article post entry story content title".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[a-z]+|[0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# The features of a block, in the order of the table.
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "in_article",
            "in_furniture", "outside")

# Labelled blocks: the features, then 1 for main text. Made by hand from usual page layouts.
LABELLED = [
    # paragraphs and headings of an article element
    (60, 0.00, 8, 0.00, 55, 0.00, 1, 0, 0.00, 1),
    (55, 0.05, 60, 0.00, 2, 0.00, 1, 0, 0.00, 1),
    (2, 0.00, 55, 0.05, 40, 0.00, 1, 0, 0.00, 1),
    (8, 0.00, 0, 0.00, 60, 0.00, 1, 0, 0.00, 1),
    (1, 0.00, 30, 0.00, 0, 0.00, 1, 0, 0.00, 1),
    (12, 0.00, 9, 0.00, 14, 0.10, 1, 0, 0.00, 1),
    (4, 0.00, 90, 0.00, 35, 0.00, 1, 0, 0.00, 1),
    (25, 0.20, 40, 0.00, 3, 1.00, 1, 0, 0.00, 1),
    (3, 1.00, 25, 0.20, 50, 0.00, 1, 0, 0.00, 1),
    (6, 0.60, 33, 0.10, 20, 0.00, 1, 0, 0.00, 1),
    (9, 0.00, 9, 0.00, 9, 0.00, 1, 0, 0.00, 1),
    (140, 0.02, 7, 0.00, 80, 0.00, 1, 0, 0.00, 1),
    (1, 0.00, 1, 0.00, 1, 0.00, 1, 0, 0.00, 1),
    (2, 1.00, 1, 1.00, 45, 0.00, 1, 0, 0.00, 1),
    (5, 0.00, 12, 1.00, 3, 0.30, 1, 0, 0.00, 1),
    # furniture inside an article: share bars, adverts, reader comments, footers
    (3, 1.00, 60, 0.00, 2, 1.00, 1, 1, 0.00, 0),
    (8, 0.00, 45, 0.00, 30, 0.00, 1, 1, 0.00, 0),
    (40, 0.00, 6, 0.30, 35, 0.00, 1, 1, 0.00, 0),
    (20, 0.10, 70, 0.00, 0, 0.00, 1, 1, 0.00, 0),
    (90, 0.00, 20, 0.00, 3, 1.00, 1, 1, 0.00, 0),
    (2, 0.00, 2, 0.00, 90, 0.00, 1, 1, 0.00, 0),
    # furniture outside: menus, headers, sidebars, notices, adverts, forms, comments, footers
    (1, 1.00, 0, 0.00, 1, 1.00, 0, 1, 0.00, 0),
    (2, 1.00, 1, 1.00, 2, 1.00, 0, 1, 0.00, 0),
    (7, 0.00, 1, 1.00, 8, 0.00, 0, 1, 0.00, 0),
    (9, 0.00, 50, 0.00, 0, 0.00, 0, 1, 0.00, 0),
    (30, 0.05, 4, 0.00, 6, 1.00, 0, 1, 0.00, 0),
    (55, 0.00, 9, 0.00, 48, 0.00, 0, 1, 0.00, 0),
    (120, 0.00, 10, 0.00, 95, 0.00, 0, 1, 0.00, 0),
    (18, 0.20, 5, 1.00, 12, 0.00, 0, 1, 0.00, 0),
    (4, 0.00, 0, 0.00, 70, 0.00, 0, 1, 0.00, 0),
    # pages without an article element: text by length, links and neighbours
    (60, 0.00, 8, 0.00, 55, 0.00, 0, 0, 0.00, 1),
    (45, 0.05, 50, 0.00, 40, 0.10, 0, 0, 0.00, 1),
    (35, 0.10, 3, 1.00, 60, 0.00, 0, 0, 0.00, 1),
    (18, 0.00, 40, 0.00, 30, 0.00, 0, 0, 0.00, 1),
    (25, 0.20, 30, 0.00, 5, 0.50, 0, 0, 0.00, 1),
    (7, 0.00, 3, 1.00, 60, 0.00, 0, 0, 0.00, 1),
    (5, 0.00, 70, 0.00, 65, 0.00, 0, 0, 0.00, 1),
    (2, 0.00, 50, 0.00, 48, 0.00, 0, 0, 0.00, 1),
    (80, 0.15, 90, 0.00, 4, 1.00, 0, 0, 0.00, 1),
    (16, 0.10, 22, 0.00, 17, 0.00, 0, 0, 0.00, 1),
    (6, 0.00, 45, 0.00, 0, 0.00, 0, 0, 0.00, 1),
    (30, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0.00, 1),
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 0, 0.00, 0),
    (2, 1.00, 0, 0.00, 2, 1.00, 0, 0, 0.00, 0),
    (4, 0.80, 3, 1.00, 2, 1.00, 0, 0, 0.00, 0),
    (3, 0.00, 2, 1.00, 4, 1.00, 0, 0, 0.00, 0),
    (6, 0.00, 1, 1.00, 2, 0.00, 0, 0, 0.00, 0),
    (5, 0.00, 4, 0.00, 6, 0.20, 0, 0, 0.00, 0),
    (12, 0.90, 40, 0.00, 10, 0.90, 0, 0, 0.00, 0),
    (20, 0.70, 18, 0.80, 25, 0.60, 0, 0, 0.00, 0),
    (8, 0.50, 6, 0.60, 3, 1.00, 0, 0, 0.00, 0),
    (2, 0.00, 3, 0.50, 2, 0.00, 0, 0, 0.00, 0),
    (35, 0.60, 50, 0.00, 8, 1.00, 0, 0, 0.00, 0),
    (9, 0.40, 2, 1.00, 1, 1.00, 0, 0, 0.00, 0),
    # weakly marked elements beside the page's text: search and sign-up forms, notices, adverts
    (1, 0.00, 13, 0.00, 2, 0.00, 1, 0, 0.95, 0), (14, 0.00, 60, 0.00, 55, 0.00, 1, 0, 0.90, 0),
    (3, 0.00, 5, 0.00, 60, 0.00, 0, 0, 0.85, 0), (14, 0.00, 2, 0.00, 2, 0.00, 0, 0, 0.50, 0),
    (40, 0.00, 2, 1.00, 35, 0.00, 0, 0, 0.75, 0), (55, 0.05, 30, 0.00, 48, 0.00, 0, 0, 0.60, 0),
    (90, 0.00, 80, 0.00, 70, 0.00, 1, 0, 0.70, 0), (2, 1.00, 1, 1.00, 2, 1.00, 0, 0, 1.00, 0),
    (25, 0.00, 40, 0.00, 1, 0.00, 0, 0, 0.45, 0), (9, 0.00, 50, 0.00, 0, 0.00, 0, 0, 0.95, 0),
    # one that holds the page's text: judged as if it were not marked
    (60, 0.00, 8, 0.00, 55, 0.00, 0, 0, 0.30, 1),
]
DEPTH, LEAF = 6, 1

RESULT = "text string, n_chars long, n_blocks long, n_kept long"


def grow(rows: list[tuple], depth: int = DEPTH, leaf: int = LEAF):
    """A classification tree by Gini impurity: (feature, cut, left, right) or a class."""
    ones = sum(r[-1] for r in rows)
    majority = int(2 * ones >= len(rows))
    if depth == 0 or ones in (0, len(rows)):
        return majority

    def impurity(part):
        share = sum(r[-1] for r in part) / len(part)
        return len(part) * share * (1 - share)

    best = None
    for feature in range(len(rows[0]) - 1):
        values = sorted({r[feature] for r in rows})
        for low, high in zip(values, values[1:]):
            cut = (low + high) / 2
            left = [r for r in rows if r[feature] <= cut]
            right = [r for r in rows if r[feature] > cut]
            if min(len(left), len(right)) >= leaf:
                score = impurity(left) + impurity(right)
                # Of equal splits the most central one: it generalises best.
                key = (round(score, 9), abs(len(left) - len(right)))
                if best is None or key < best[0]:
                    best = (key, feature, cut, left, right)
    if best is None or best[0][0] >= impurity(rows):
        return majority
    _, feature, cut, left, right = best
    return feature, cut, grow(left, depth - 1, leaf), grow(right, depth - 1, leaf)


def decide(tree, row: tuple) -> int:
    while not isinstance(tree, int):
        feature, cut, left, right = tree
        tree = left if row[feature] <= cut else right
    return tree


# Marks of an element, the strongest last.
NONE, LOOSE, TEASER, COMMENT, FIRM, HIDDEN = range(6)


def mark_of(tag: str, attributes: str, inside_article: bool) -> int:
    if tag in ("html", "body", "article", "main"):
        return NONE
    mark = LOOSE if tag == "form" else NONE
    if tag in FURNITURE_TAGS or tag == "header" and not inside_article:
        mark = FIRM
    if not attributes.strip():
        return mark
    given: dict[str, str] = {}
    for match in ATTRIBUTE.finditer(attributes):
        given.setdefault(match[1].lower(), match[2] or match[3] or match[4] or "")
    if ("hidden" in given or given.get("aria-hidden", "").lower() == "true"
            or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""), re.I)):
        return HIDDEN
    role = given.get("role", "").strip().lower()
    if role in FURNITURE_ROLES:
        mark = FIRM
    elif role == "form":
        mark = max(mark, LOOSE)
    if tag in HEADINGS:     # its names are those of its place
        return mark
    names = given.get("class", "").split()
    if tag not in ANCHORS and "section" not in names:
        names += given.get("id", "").split()
    for name in names:
        parts = NAME_PARTS.findall(CAMEL.sub("-", name).lower())
        if LAYOUT_NAMES.intersection(parts):
            continue
        named = FURNITURE_NAMES.intersection(parts)
        if named and not (named == {"header"} and ARTICLE_NAMES.intersection(parts)):
            mark = max(mark, LOOSE)
        if TEASER_NAMES.intersection(parts):
            mark = max(mark, TEASER)
        if COMMENT_NAMES.intersection(parts) or "-".join(parts) in COMMENT_AREAS:
            mark = max(mark, COMMENT)
    return mark


def text_blocks(html: str) -> list[tuple[str, int, int, int, int, float]]:
    """(text, words, words in links, in an article, in furniture, share of plain words outside), in page order."""
    blocks: list[tuple[str, int, int, bool, int, int, int]] = []
    # Of open non-inline elements: tag, article, firm mark, comment area, area of a weak mark.
    stack: list[tuple[str, bool, int, int, int]] = []
    article, firm, comment, area = False, NONE, -1, -1
    comments: list[list] = []       # enclosing one, whether it holds the page's title
    areas: list[tuple[int, int]] = []       # enclosing one, its mark
    parts: list[str] = []
    linked: list[str] = []
    in_link = 0
    silent = ""

    def close():
        nonlocal parts, linked
        if parts:
            words = "".join(parts).split()
            if words:
                n_linked = len("".join(linked).split())
                blocks.append((" ".join(words), len(words), min(n_linked, len(words)), article, firm, comment, area))
            parts, linked = [], []

    def pop_to(depth: int):
        nonlocal article, firm, comment, area, in_link
        del stack[depth:]
        article, firm, comment, area = stack[-1][1:] if stack else (False, NONE, -1, -1)
        in_link = 0

    # Marks of character data go; what they enclose is read like the rest.
    if "<![CDATA[" in html:
        html = html.replace("<![CDATA[", " ").replace("]]>", " ")
    position, size = 0, len(html)
    while position < size:
        if silent:      # skip to its end tag
            end = re.compile(rf"</{re.escape(silent)}(?=[\s/>])[^>]*>?", re.I).search(html, position)
            position, silent = (end.end() if end else size), ""
            continue
        token = TOKEN.match(html, position)
        position = token.end()
        tag = token[2] or token[5]
        if tag is None:
            piece = token[0]
            if piece[:2] not in ("<!", "<?"):
                piece = unescape(piece) if "&" in piece else piece
                parts.append(piece)
                if in_link:
                    linked.append(piece)
            continue
        tag, closing = tag.lower(), token[1] or token[4]
        attributes = token[3] if token[2] else token[6] or ""
        if not closing and tag in SILENT:
            if not attributes.endswith("/"):
                silent = tag
            if tag not in INLINE:
                parts.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
                linked.append(" ")
            continue
        if tag in SPACE:
            parts.append(" ")
            continue
        close()
        if tag in VOID:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    pop_to(depth)
                    break
                if tag not in SCOPE and stack[depth][0] in SCOPE:
                    break
            continue
        ended = IMPLIED_END.get(tag)
        if ended or stack and stack[-1][0] == "p":
            if stack and (stack[-1][0] in (ended or ()) or stack[-1][0] == "p"):
                pop_to(len(stack) - 1)
        mark = mark_of(tag, attributes, article)
        if mark in (LOOSE, TEASER):
            areas.append((area, mark))
            area = len(areas) - 1
        elif mark == COMMENT:
            comments.append([comment, False])
            comment = len(comments) - 1
        else:
            firm = max(firm, mark)
        # The page's main element ends all marks but hidden ones; an article those of elements that hold no others.
        if tag == "main":
            firm, comment = firm if firm == HIDDEN else NONE, -1
        if area >= 0 and (tag == "main" or tag == "article" and areas[area][1] == LOOSE):
            areas.append((area, NONE))
            area = len(areas) - 1
        if tag == "h1" and comment >= 0:
            comments[comment][1] = True
        article = article or tag in ("article", "main")
        stack.append((tag, article, firm, comment, area))
    close()
    return weighed(blocks, comments, areas)


def weighed(blocks: list[tuple], comments: list[list], areas: list[tuple[int, int]]) -> list[tuple]:
    for outer, titled in reversed(comments):        # inner ones come later
        if outer >= 0 and titled:
            comments[outer][1] = True
    furniture = [int(firm != NONE or comment >= 0 and not comments[comment][1]) for *_, firm, comment, _ in blocks]
    inside, total = [0] * len(areas), 0
    for (_, words, linked, _, _, _, area), aside in zip(blocks, furniture):
        if not aside:
            total += words - linked
            if area >= 0:
                inside[area] += words - linked
    for i in range(len(areas) - 1, -1, -1):
        if areas[i][0] >= 0:
            inside[areas[i][0]] += inside[i]
    # The innermost element counts: of those around a block it leaves the most outside.
    outside = [0.0 if mark == NONE else 1 - inside[i] / total if total else 1.0 for i, (_, mark) in enumerate(areas)]
    return [(text, words, linked, int(article), aside, outside[area] if area >= 0 else 0.0)
            for (text, words, linked, article, _, _, area), aside in zip(blocks, furniture)]


def main_text(html: str | None, tree) -> tuple[str, int, int]:
    """The kept blocks joined by one space, the count of all blocks and of kept ones."""
    blocks = text_blocks(html or "")
    described = [(words, linked / words) for _, words, linked, *_ in blocks]
    kept = []
    for i, (text, _, _, *places) in enumerate(blocks):
        before = described[i - 1] if i else (0, 0.0)
        after = described[i + 1] if i + 1 < len(blocks) else (0, 0.0)
        if decide(tree, (*described[i], *before, *after, *places)):
            kept.append(text)
    return " ".join(kept), len(blocks), len(kept)


def _start():
    tree = grow(LABELLED)

    def step(pages):
        rows = [main_text(html, tree) for html in pages]
        return ([r[0] for r in rows], [len(r[0]) for r in rows], [r[1] for r in rows], [r[2] for r in rows])

    return step


def extract(pages: DataFrame, name: str, *, html: str = "html") -> DataFrame:
    """``pages`` with the struct ``name`` (RESULT): main text, its code points, blocks, kept blocks."""
    return with_result(pages, [html], RESULT, _start, name)
