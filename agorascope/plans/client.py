"""A model service over HTTP as a plain function from prompt to reply, by the common chat-completions form."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from email.utils import parsedate_to_datetime

from agorascope.config import Busy, credential

#: Answers after which another try may help.
AGAIN = {408, 409, 429, 500, 502, 503, 504}
#: What a request holds unless settings say otherwise.
DEFAULTS = {"system": "You are a helpful assistant.", "temperature": 0.3, "max_tokens": 512, "timeout": 60.0, "retries": 2}


def part_text(part: object) -> str:
    """What a part of a reply says: a string itself, a part of text its text. Other kinds (images, calls of tools) say nothing."""
    if isinstance(part, dict):
        part = part.get("text")
    return part if isinstance(part, str) else ""


def content(answer: object) -> str:
    """The text of an answer's first choice, its parts joined and white space around it taken off; empty if there is none.

    The service documents {"choices": [{"message": {"content": text or list of parts}}]}; what has another form has no text."""
    try:
        said = answer["choices"][0]["message"]["content"]
    except (KeyError, IndexError, TypeError):
        return ""
    return "".join(map(part_text, said if isinstance(said, list) else [said])).strip()


def retry_after(value: str | None, now: float) -> float | None:
    """Seconds that a Retry-After header asks for: a number, or a date of HTTP; None without one that can be read."""
    try:
        return max(0.0, float(value))
    except (TypeError, ValueError):
        pass
    try:
        return max(0.0, parsedate_to_datetime(value).timestamp() - now)
    except (TypeError, ValueError):
        return None


def chat_model(url: str, model: str, key: str, system: str = DEFAULTS["system"], temperature: float = DEFAULTS["temperature"], max_tokens: int = DEFAULTS["max_tokens"], timeout: float = DEFAULTS["timeout"], retries: int = DEFAULTS["retries"], wait: float = 0.5, headers: dict[str, str] | None = None) -> Callable[[str], str]:
    """A function for labeling.ask. url is the service's base; calls go to its chat/completions, from the workers.

    Lost connections and answers of AGAIN are tried again, after a wait that doubles; other errors are raised at once. An answer
    that says how long to wait (Retry-After) is not tried here: it is raised as config.Busy, so that who paces the calls waits."""
    sent = {"Content-Type": "application/json", "Authorization": f"Bearer {key}"} | (headers or {})

    def call(prompt: str) -> str:
        messages = [{"role": "system", "content": system}, {"role": "user", "content": prompt}]
        body = json.dumps({"model": model, "messages": messages, "temperature": temperature, "max_tokens": max_tokens}).encode()
        for turn in range(retries + 1):
            if turn:
                time.sleep(wait * 2 ** (turn - 1))
            try:
                with urllib.request.urlopen(urllib.request.Request(f"{url.rstrip('/')}/chat/completions", body, sent), timeout=timeout) as got:
                    return content(json.load(got))
            except urllib.error.HTTPError as e:
                asked = retry_after(e.headers.get("Retry-After"), time.time()) if e.code in AGAIN else None
                if asked is not None:
                    raise Busy(f"{e.code}, retry after {asked:g} s", asked) from e
                if e.code not in AGAIN or turn == retries:
                    raise
            except OSError:
                if turn == retries:
                    raise
        return ""

    return call


def from_settings(settings: dict, variable: str = "MODEL_API_KEY", environment: dict[str, str] | None = None) -> Callable[[str], str]:
    """The function that settings["model"] describes: url, name, api_key (the environment's variable goes first) and options."""
    own = settings.get("model") or {}
    key = credential(settings, ("model", "api_key"), variable, environment)
    if not key or not own.get("url") or not own.get("name"):
        raise ValueError(f"a model service needs model.url, model.name and {variable} or model.api_key")
    options = {k: own[k] for k in ("system", "temperature", "max_tokens", "timeout", "retries", "wait", "headers") if own.get(k) is not None}
    return chat_model(own["url"], own["name"], key, **options)
