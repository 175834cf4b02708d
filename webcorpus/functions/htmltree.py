"""A small HTML tree for per-page extraction inside Spark tasks.

Built from the events of the stdlib's ``HTMLParser``.  It repairs what page
selectors need: void elements, implied ends of ``p``/``li``/
``dd``/``dt``/``tr``/``td``/``th``, stray end tags, and keeps source
offsets so a node's markup can be sliced from the page verbatim.
Entities are decoded in text and attribute values.
"""

from __future__ import annotations

from html.parser import HTMLParser

# HTML void elements and implied-end rules.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# new start tag -> open tags it closes, and the tags that stop the search
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
BLOCK_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "start", "end", "inner_start", "inner_end")

    def __init__(self, tag, attrs, parent, start, inner_start):
        self.tag = tag
        self.attrs = attrs
        self.children = []          # Node or str (text)
        self.parent = parent
        self.start = start          # offset of '<'
        self.inner_start = inner_start
        self.inner_end = None
        self.end = None             # offset after the end tag

    # -- navigation -------------------------------------------------------
    def elements(self, tag=None):
        """Direct child elements, optionally of one tag (``tag`` children)."""
        return [c for c in self.children if isinstance(c, Node) and (tag is None or c.tag == tag)]

    def iter(self, tag=None):
        """Descendant elements in document order (``.//tag``)."""
        stack = list(reversed(self.elements()))
        while stack:
            n = stack.pop()
            if tag is None or n.tag == tag:
                yield n
            stack.extend(reversed(n.elements()))

    def texts(self):
        """Direct text nodes (``text()``)."""
        return [c for c in self.children if isinstance(c, str)]

    @property
    def text(self):
        """Text before the first child element (``.text``), or None."""
        if self.children and isinstance(self.children[0], str):
            return self.children[0]
        return None

    def get(self, name, default=None):
        return self.attrs.get(name, default)

    def has_class(self, word):
        """``contains(@class, word)``: a substring test, as in XPath."""
        return word in (self.attrs.get("class") or "")

    def markup(self, source):
        """The node's markup, sliced verbatim from the page source."""
        return source[self.start:self.end if self.end is not None else len(source)]


class _Tree:
    """Builds the tree from tag events that carry source offsets."""

    def __init__(self, source):
        self.source = source
        self.root = Node("#document", {}, None, 0, 0)
        self.stack = [self.root]

    def _close_to(self, idx, at):
        for n in self.stack[idx:]:
            n.inner_end = n.inner_end if n.inner_end is not None else at
            n.end = n.end if n.end is not None else at
        del self.stack[idx:]

    def _implied(self, tag, at):
        if tag in IMPLIED_END:
            closes, stops = IMPLIED_END[tag]
            for i in range(len(self.stack) - 1, 0, -1):
                t = self.stack[i].tag
                if t in closes:
                    self._close_to(i, at)
                    break
                if t in stops:
                    break
        if tag in BLOCK_CLOSES_P:
            for i in range(len(self.stack) - 1, 0, -1):
                t = self.stack[i].tag
                if t == "p":
                    self._close_to(i, at)
                    break
                if t in ("div", "article", "section", "td", "th", "li", "body", "main", "nav", "button"):
                    break

    def start(self, tag, attrs, at, raw_len, self_closing=False):
        """``attrs``: a dict of name -> value ("" when the value is missing)."""
        if tag in IMPLIED_END or tag in BLOCK_CLOSES_P:
            self._implied(tag, at)
        parent = self.stack[-1]
        node = Node(tag, attrs, parent, at, at + raw_len)
        parent.children.append(node)
        if self_closing or tag in VOID:
            node.inner_end = node.end = at + raw_len
        else:
            self.stack.append(node)

    def end(self, tag, at, end):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                node = self.stack[i]
                self._close_to(i + 1, at)
                node.inner_end, node.end = at, end
                del self.stack[i:]
                return
        # an end tag with no open element is ignored

    def data(self, text):
        if not text:
            return
        parent = self.stack[-1]
        if parent.children and isinstance(parent.children[-1], str):
            parent.children[-1] += text
        else:
            parent.children.append(text)

    def finish(self):
        self._close_to(1, len(self.source))
        return self.root


def _as_dict(attrs):
    return {k: (v if v is not None else "") for k, v in attrs}


class _Builder(HTMLParser):
    """Feeds parser events, with their places in the source, to a ``_Tree``."""

    def __init__(self, tree):
        super().__init__(convert_charrefs=True)
        self.tree = tree
        src = tree.source
        self.line_starts = [0]
        i = src.find("\n")
        while i >= 0:
            self.line_starts.append(i + 1)
            i = src.find("\n", i + 1)

    def _offset(self):
        line, col = self.getpos()
        return self.line_starts[line - 1] + col

    def handle_starttag(self, tag, attrs):
        self.tree.start(tag, _as_dict(attrs), self._offset(), len(self.get_starttag_text() or ""))

    def handle_startendtag(self, tag, attrs):
        self.tree.start(tag, _as_dict(attrs), self._offset(), len(self.get_starttag_text() or ""), True)

    def handle_endtag(self, tag):
        at = self._offset()
        gt = self.tree.source.find(">", at)
        self.tree.end(tag, at, gt + 1 if gt >= 0 else len(self.tree.source))

    def handle_data(self, data):
        self.tree.data(data)


def parse(source: str) -> Node:
    """Parse a page into a tree rooted at a ``#document`` node."""
    tree = _Tree(source or "")
    builder = _Builder(tree)
    builder.feed(source or "")
    builder.close()
    return tree.finish()


# -- selector helpers (XPath-like, 1-based positions) ------------------------

def nth(nodes, i):
    """``x[i]`` with i 1-based; ``-1`` is ``last()``; None when missing."""
    if not nodes:
        return None
    if i == -1:
        return nodes[-1]
    return nodes[i - 1] if 0 < i <= len(nodes) else None


def child(node, tag, i=1, pred=None):
    """``tag[pred][i]`` among the direct children of ``node``."""
    if node is None:
        return None
    kids = [k for k in node.elements(tag) if pred is None or pred(k)]
    return nth(kids, i)


def select(node, *steps):
    """All nodes reached by a chain of child steps, in document order, as
    an XPath location path selects them: each step is ``tag`` or ``(tag,
    i)`` or ``(tag, i, pred)`` (``i`` 1-based among the matching children
    of each parent, -1 = ``last()``, None = all)."""
    cur = [] if node is None else [node]
    for st in steps:
        tag, i, pred = (st, None, None) if isinstance(st, str) else (tuple(st) + (None, None))[:3]
        nxt = []
        for n in cur:
            kids = [k for k in n.elements(tag) if pred is None or pred(k)]
            if i is None:
                nxt.extend(kids)
            else:
                k = nth(kids, i)
                if k is not None:
                    nxt.append(k)
        cur = nxt
    return cur


def first(nodes):
    return nodes[0] if nodes else None


def first_text_in(nodes):
    """``(...)/text()[1]`` over a node list: the first direct text node of
    any of them, in order."""
    for n in nodes:
        t = n.texts()
        if t:
            return t[0]
    return None


def first_attr(nodes, name):
    """``(...)/@name[1]``: the attribute of the first node that has it."""
    for n in nodes:
        if name in n.attrs:
            return n.attrs[name]
    return None


def path(node, *steps):
    """Follow ``(tag, i)`` or ``(tag, i, pred)`` child steps; None if any is missing."""
    for st in steps:
        node = child(node, *st) if isinstance(st, tuple) else child(node, st)
        if node is None:
            return None
    return node


def find_all(node, tag=None, pred=None):
    """``.//tag[pred]`` in document order."""
    if node is None:
        return []
    return [n for n in node.iter(tag) if pred is None or pred(n)]


def find(node, tag=None, pred=None):
    for n in ([] if node is None else node.iter(tag)):
        if pred is None or pred(n):
            return n
    return None


def first_text(node):
    """``text()[1]``: the first direct text node, or None."""
    if node is None:
        return None
    t = node.texts()
    return t[0] if t else None


def all_text(node):
    """Text content of a node (all descendant text, in order)."""
    if node is None:
        return None
    out = []
    stack = [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            out.append(n)
        else:
            stack.extend(reversed(n.children))
    return "".join(out)
