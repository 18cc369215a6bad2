"""Plain-Python (``re``) application of a rule chain, used as a test oracle.

It runs the same Step table with CPython's regex engine, which is the
engine the upstream rules were written for, so any Java/Python regex
difference in a rule shows up as a mismatch.
"""

import re

from scribal.operators.rulechain import Step


def _py_pattern(p: str) -> str:
    return p.replace("(?d)", "")


def _py_repl(r: str) -> str:
    return re.sub(r"\$(\d)", r"\\\1", r)


def apply_steps(text: str, chain, text_id: str = "", patches=()) -> str:
    for s in chain:
        if s.kind in ("fold", "gfold"):
            for a, b in s.all_pairs():
                text = text.replace(a, b)
        elif s.kind == "regex":
            text = re.sub(_py_pattern(s.pattern), _py_repl(s.repl), text)
        elif s.kind == "patch":
            for tid, where, old, new in patches:
                if where == s.name and tid == text_id:
                    text = text.replace(old, new)
        elif s.kind == "find":
            for m in re.findall(_py_pattern(s.pattern), text):
                if s.rewrite == "const":
                    text = text.replace(m, s.repl)
                elif s.rewrite == "swap":
                    text = text.replace(m, m.replace(*s.swap))
                elif s.rewrite == "bar":
                    if "-" in m:
                        m = m.replace("-", "")
                    text = text.replace(m, m + "-")
    return text


assert Step
