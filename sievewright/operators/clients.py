"""Language-model clients for re-authoring."""

from __future__ import annotations

import json
import os
import time
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol


class ModelError(RuntimeError):
    """The call itself failed, after its own attempts."""


@dataclass
class Answer:
    text: str
    model: str
    attempts: int = 1


class Client(Protocol):
    def call(self, prompt: str, system: str = "", temperature: float = 0.0, max_tokens: int = 512, timeout: float = 60.0) -> Answer: ...


@dataclass
class ScriptedClient:
    """Answers from a function, else from a list whose last entry repeats, else an error object."""

    answer: Callable[[str], str] | None = None
    script: list[str] = field(default_factory=list)
    calls: list[str] = field(default_factory=list)

    def call(self, prompt, system="", temperature=0.0, max_tokens=512, timeout=60.0) -> Answer:
        self.calls.append(prompt)
        if self.answer:
            return Answer(self.answer(prompt), "scripted")
        if self.script:
            return Answer(self.script[min(len(self.calls), len(self.script)) - 1], "scripted")
        return Answer('{"error":"no scripted answer"}', "scripted")


@dataclass
class HttpClient:
    """A local generation server that takes prompt and options as JSON."""

    url: str = "http://127.0.0.1:11434/api/generate"
    model: str = "default"
    retries: int = 2
    pause: float = 1.0

    def call(self, prompt, system="", temperature=0.0, max_tokens=512, timeout=60.0) -> Answer:
        body = {"model": self.model, "prompt": prompt, "system": system, "stream": False, "options": {"temperature": temperature, "num_predict": max_tokens}}
        error: Exception | None = None
        for attempt in range(1, self.retries + 2):
            try:
                request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json"})
                with urllib.request.urlopen(request, timeout=timeout) as r:
                    v = json.load(r)
                text = v.get("response") or v.get("text") or next((x.get("text") for x in v.get("results") or []), None)
                if text:
                    return Answer(text, self.model, attempt)
                raise ValueError("the answer has no text")
            except (OSError, ValueError, AttributeError) as e:
                error = e
                if attempt <= self.retries:
                    time.sleep(self.pause * attempt)
        raise ModelError(f"{self.url}: {error}")


def default_client() -> Client:
    """By the environment: ``SIEVEWRIGHT_MODEL_URL`` names a server, else a scripted client."""
    url = os.environ.get("SIEVEWRIGHT_MODEL_URL")
    return HttpClient(url, os.environ.get("SIEVEWRIGHT_MODEL", "default")) if url else ScriptedClient()
