"""What surrounds a text model: prompts of templates, answers that come in parts, and stopping."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable


def template_prompt(template) -> str:
    """A template (text, dictionary, or a class or object with fields) as the text that a model gets."""
    if isinstance(template, str):
        return template
    if isinstance(template, dict):
        return json.dumps(template, indent=2)
    made = template() if isinstance(template, type) else template
    return json.dumps(made.model_dump() if hasattr(made, "model_dump") else vars(made), indent=2)


def streamed(lines: Iterable[str], stop: Callable[[str], bool] | None = None) -> str:
    """The text of a streamed answer: the data of its events up to the end mark, or until ``stop`` has seen enough."""
    text = ""
    for line in lines:
        if not line.startswith("data:"):
            continue
        data = line[5:].strip()
        if data == "[DONE]":
            break
        try:
            choices = json.loads(data).get("choices") or [{}]
        except json.JSONDecodeError:
            continue
        text += (choices[0].get("delta") or {}).get("content") or choices[0].get("text") or ""
        if stop is not None and stop(text):
            break
    return text


class RepetitionStopper:
    """Says when a model repeats itself: the same tag and text at least ``times`` times in a row, at places that come
    again or that are spaced evenly (within a fifth)."""

    BLOCK = re.compile(r"<(\w+)>((?:<loc_\d+>)*)([^<]*)</\1>")

    def __init__(self, times: int = 3):
        self.times = times

    def __call__(self, text: str) -> bool:
        run: list[tuple[int, ...]] = []
        before = None
        for m in self.BLOCK.finditer(text):
            what = (m[1], m[3].strip())
            place = tuple(map(int, re.findall(r"\d+", m[2])))
            run = [*run, place] if what == before else [place]
            before = what
            if len(run) >= self.times and what[1] and (len(set(run)) < len(run) or self._even(run)):
                return True
        return False

    @staticmethod
    def _even(run: list[tuple[int, ...]]) -> bool:
        if not all(len(p) >= 2 for p in run):
            return False
        for axis in (0, 1):
            steps = [b[axis] - a[axis] for a, b in zip(run, run[1:])]
            if not all(abs(s - steps[0]) <= 0.2 * abs(steps[0]) for s in steps):
                return False
        return True


def in_batches(rows: Iterable, size: int):
    """Consecutive groups of at most ``size``."""
    group: list = []
    for r in rows:
        group.append(r)
        if len(group) == size:
            yield group
            group = []
    if group:
        yield group
