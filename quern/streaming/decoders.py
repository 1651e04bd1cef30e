"""Decoders of streamed model output: handles that may be cut between pieces, and one text field of a growing JSON."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping


class HandleDecoder:
    """Replaces handles such as ``[[c3]]`` in streamed text, holding back what may be the beginning of one; unknown handles stay."""

    def __init__(self, names: Mapping[str, str], begin: str = "[[", end: str = "]]", longest: int = 40):
        self.names, self.begin, self.end, self.longest, self.held = names, begin, end, longest, ""
        self.used: list[str] = []

    def feed(self, piece: str) -> str:
        self.held += piece
        out = []
        while self.held:
            at = self.held.find(self.begin)
            if at < 0:
                keep = next((n for n in range(min(len(self.begin) - 1, len(self.held)), 0, -1) if self.begin.startswith(self.held[-n:])), 0)
                out.append(self.held[: len(self.held) - keep])
                self.held = self.held[len(self.held) - keep :]
                break
            out.append(self.held[:at])
            self.held = self.held[at:]
            close = self.held.find(self.end, len(self.begin))
            if close < 0:
                if len(self.held) <= self.longest:
                    break
                # too long for a handle: let its beginning go
                out.append(self.held[: len(self.begin)])
                self.held = self.held[len(self.begin) :]
                continue
            key = self.held[len(self.begin) : close]
            if key in self.names:
                self.used.append(key)
                out.append(self.names[key])
            else:
                out.append(self.held[: close + len(self.end)])
            self.held = self.held[close + len(self.end) :]
        return "".join(out)

    def close(self) -> str:
        out, self.held = self.held, ""
        return out


class JsonFieldDecoder:
    """The text of one string field of a JSON object as it grows; escapes cut between pieces wait for their rest."""

    _ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", '"': '"', "\\": "\\", "/": "/"}

    def __init__(self, name: str = "answer"):
        self.open = re.compile(r'"' + re.escape(name) + r'"\s*:\s*"')
        self.held, self.inside, self.done = "", False, False

    def feed(self, piece: str) -> str:
        if self.done:
            return ""
        self.held += piece
        if not self.inside:
            m = self.open.search(self.held)
            if not m:
                return ""
            self.inside, self.held = True, self.held[m.end() :]
        out, i, s = [], 0, self.held
        while i < len(s):
            c = s[i]
            if c == '"':
                self.done = True
                i = len(s)
                break
            if c == "\\":
                if i + 1 >= len(s):
                    break
                if s[i + 1] == "u":
                    need = 12 if re.match(r"\\u[dD][89abAB]", s[i : i + 4]) else 6
                    if i + need > len(s):
                        break
                    text = s[i : i + need]
                    out.append("".join(chr(int(x, 16)) for x in re.findall(r"\\u([0-9a-fA-F]{4})", text)).encode("utf-16", "surrogatepass").decode("utf-16", "replace"))
                    i += need
                    continue
                out.append(self._ESCAPES.get(s[i + 1], s[i + 1]))
                i += 2
                continue
            out.append(c)
            i += 1
        self.held = s[i:]
        return "".join(out)


class EventBus:
    """Handlers by kind of event, called in the order they came; an error of one is collected, not passed over."""

    def __init__(self):
        self.handlers: dict[str, list[Callable[[dict], object]]] = {}

    def on(self, kind: str, handler: Callable[[dict], object]) -> None:
        self.handlers.setdefault(kind, []).append(handler)

    def emit(self, kind: str, event: dict) -> list:
        """The results of all handlers; raises the first error after all have run."""
        out, bad = [], None
        for h in self.handlers.get(kind, ()):
            try:
                out.append(h(event))
            except Exception as e:  # noqa: BLE001
                bad = bad or e
        if bad is not None:
            raise bad
        return out
