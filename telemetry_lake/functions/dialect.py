"""Patterns with one meaning: RE2's, as SQL engines built on it read them.

Spark searches with Java's regular expressions.  ``portable`` gives the Java
pattern that finds what RE2 finds for the same text, and refuses by name what
has no such form.
"""

from __future__ import annotations

import re


class DialectError(ValueError):
    """A pattern that RE2 and Java don't both have, or that they read apart."""


_WORD = "0-9A-Za-z_"
_SPACE = r"\t\n\f\r "  # RE2's \s leaves out the vertical tab, Java's has it
_EDGE = rf"(?:(?<=[{_WORD}])(?![{_WORD}])|(?<![{_WORD}])(?=[{_WORD}]))"
_NO_EDGE = rf"(?:(?<=[{_WORD}])(?=[{_WORD}])|(?<![{_WORD}])(?![{_WORD}]))"
_SAME = set("dDwWaftnrA")  # escapes with equal meaning outside classes
_POSIX = {"alnum": "Alnum", "alpha": "Alpha", "ascii": "ASCII", "blank": "Blank", "cntrl": "Cntrl", "digit": "Digit",
          "graph": "Graph", "lower": "Lower", "print": "Print", "punct": "Punct", "space": "Space", "upper": "Upper",
          "xdigit": "XDigit"}
_CATEGORY = re.compile(r"(?:C[cfos]?|L[lmotu]?|M[cen]?|N[dlo]?|P[cdefios]?|S[ckmo]?|Z[lps]?)\Z")
_COUNT = re.compile(r"\{(\d+)(?:,(\d*))?\}")
_GROUPS = (("(?=", "look-ahead"), ("(?!", "look-ahead"), ("(?<=", "look-behind"), ("(?<!", "look-behind"),
           ("(?>", "atomic group"), ("(?#", "comment group"), ("(?|", "branch reset"), ("(?<", "named group without P"))
_NAMED = re.compile(r"\(\?P<([A-Za-z][A-Za-z0-9]*)>")
_FLAGS = re.compile(r"\(\?([a-zA-Z]*)(?:-([a-zA-Z]*))?([:)])")
_HEX = re.compile(r"x(?:[0-9A-Fa-f]{2}|\{[0-9A-Fa-f]{1,6}\})")


class _Reader:
    def __init__(self, pattern: str):
        self.text, self.at, self.out = pattern, 0, []
        self.dot_all = [False]  # of the open groups

    def refuse(self, what: str):
        raise DialectError(f"{what} at {self.at} of pattern {self.text!r}")

    def escape(self, in_class: bool) -> str:
        """The escape at ``at``; moves behind it."""
        rest = self.text[self.at + 1 :]
        if not rest:
            self.refuse("backslash at the end")
        c = rest[0]
        self.at += 2
        if not c.isalnum():
            if ord(c) > 127:
                self.refuse("escaped letter beyond ASCII")
            return "\\" + c
        if c in "pP":
            name = rest[1 : rest.index("}") + 1] if rest[1:2] == "{" and "}" in rest else rest[1:2]
            self.at += len(name)
            plain = name.strip("{}")
            negated = plain.startswith("^")
            plain = plain.lstrip("^")
            if _CATEGORY.match(plain):
                kind = plain
            elif re.fullmatch(r"[A-Z][a-z]+(?:_[A-Z][a-z]+)*", plain) and len(plain) > 2:
                kind = "Is" + plain  # scripts
            else:
                self.refuse(f"property {name}")
            return "\\" + ("pP"[(c == "P") ^ negated]) + "{" + kind + "}"
        hexa = _HEX.match(rest)
        if hexa:
            self.at += len(hexa.group()) - 1
            return "\\" + hexa.group()
        if c == "v":
            return r"\x0B"
        if c == "s":
            return _SPACE if in_class else f"[{_SPACE}]"
        if in_class:
            if c in "dDwWaftnr":
                return "\\" + c
        elif c in _SAME:
            return "\\" + c
        elif c == "S":
            return f"[^{_SPACE}]"
        elif c == "z":
            return r"\z"
        elif c == "b":
            return _EDGE
        elif c == "B":
            return _NO_EDGE
        self.at -= 2
        self.refuse("back-reference" if c in "123456789k" else f"escape \\{c}" + (" in a class" if in_class else ""))

    def char_class(self) -> str:
        text, out, opened = self.text, "[", self.at
        self.at += 1
        if text[self.at : self.at + 1] == "^":
            out, self.at = out + "^", self.at + 1
        first = True
        while True:
            c = text[self.at : self.at + 1]
            if not c:
                self.at = opened
                self.refuse("class without end")
            if c == "]" and not first:
                self.at += 1
                return out + "]"
            first = False
            posix = re.compile(r"\[:(\^?)([a-z]+):\]").match(text, self.at)
            if posix:
                if posix.group(2) == "word":
                    out += r"\W" if posix.group(1) else r"\w"
                elif posix.group(2) in _POSIX:
                    out += ("\\P{" if posix.group(1) else "\\p{") + _POSIX[posix.group(2)] + "}"
                else:
                    self.refuse(f"class {posix.group()}")
                self.at = posix.end()
            elif c == "\\":
                out += self.escape(True)
            else:  # what opens a class or an intersection in Java stands for itself in RE2
                out += "\\" + c if c in "[]&^~# " else c
                self.at += 1

    def group(self) -> str:
        text = self.text
        for start, name in _GROUPS:
            if text.startswith(start, self.at):
                self.refuse(name)
        named, flags = _NAMED.match(text, self.at), _FLAGS.match(text, self.at)
        if named:
            self.at = named.end()
            self.dot_all.append(self.dot_all[-1])
            return f"(?<{named.group(1)}>"
        if flags:
            on, off, end = flags.groups()
            for flag in (on or "") + (off or ""):
                if flag not in "is":
                    self.refuse(f"flag {flag}")
            self.at = flags.end()
            if end == ":":
                self.dot_all.append(self.dot_all[-1])
            if "s" in (off or ""):
                self.dot_all[-1] = False
            elif "s" in (on or ""):
                self.dot_all[-1] = True
            # case is ignored by Unicode's simple folding, as RE2 does
            java = ("iu" if "i" in (on or "") else "") + ("-iu" if "i" in (off or "") else "")
            return f"(?{java}{end}" if java or end == ":" else ""
        if text.startswith("(?", self.at):
            self.refuse("group " + text[self.at : self.at + 4])
        self.at += 1
        self.dot_all.append(self.dot_all[-1])
        return "("

    def repeat(self, length: int) -> str:
        """The quantifier of ``length`` characters at ``at``, with a lazy mark."""
        text = self.text
        found = text[self.at : self.at + length]
        self.at += length
        if text[self.at : self.at + 1] == "?":
            found, self.at = found + "?", self.at + 1
        if text[self.at : self.at + 1] in ("*", "+", "?") or _COUNT.match(text, self.at):
            self.refuse("possessive or repeated quantifier")
        return found

    def java(self) -> str:
        text, out = self.text, self.out
        while self.at < len(text):
            c = text[self.at]
            count = _COUNT.match(text, self.at)
            if text.startswith("\\Q", self.at):
                end = text.find("\\E", self.at)
                quoted = text[self.at + 2 : end if end >= 0 else len(text)]
                out.append(re.sub(r"([^0-9A-Za-z_\x80-\U0010FFFF])", r"\\\1", quoted))
                self.at = end + 2 if end >= 0 else len(text)
            elif c == "\\":
                out.append(self.escape(False))
            elif c == "[":
                out.append(self.char_class())
            elif c == "(":
                out.append(self.group())
            elif c == ")":
                if len(self.dot_all) == 1:
                    self.refuse("bracket that was not opened")
                self.dot_all.pop()
                out.append(c)
                self.at += 1
            elif c == ".":
                out.append(r"[\x{0}-\x{10FFFF}]" if self.dot_all[-1] else r"[^\n]")
                self.at += 1
            elif c == "$":
                out.append(r"\z")
                self.at += 1
            elif c in "*+?" or count:
                if not out or out[-1] in ("(", "(?:", "|", "^") or out[-1].startswith(("(?<", "(?i", "(?-")):
                    self.refuse("quantifier of nothing")
                if count and max(int(n) for n in count.groups("0") if n) > 1000:
                    self.refuse("count over 1000")
                out.append(self.repeat(len(count.group()) if count else 1))
            else:
                out.append("\\" + c if c in "{}]" else c)
                self.at += 1
        if len(self.dot_all) > 1:
            self.refuse("bracket that was not closed")
        return "".join(out)


def portable(pattern: str) -> str:
    """The Java pattern that finds what RE2 finds; ``DialectError`` names what neither or only one of them has.

    Translated: ``.``, ``$``, ``\\s``, ``\\b``, ``\\v``, literal braces, brackets in
    classes, POSIX classes, scripts, ``(?P<name>...)`` and case folding.
    Refused: look-around, atomic groups, back-references, possessive
    quantifiers, counts over 1000, the flags m, x, u, U and d, and escapes of one engine
    (``\\h``, ``\\R``, ``\\G``, ``\\Z``, ``\\C`` and others).
    """
    return _Reader(pattern).java()
