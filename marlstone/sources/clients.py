"""Two engines that fetch: a crawler service and plain HTTP.  Both get their transport from
outside, so nothing here opens a connection; and both can be sent to executors."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, Protocol

FIELDS = ("markdown", "html", "raw_html", "links", "metadata")


class NotThere(LookupError):
    """The address has no page (404)."""


class Client(Protocol):
    """What a collector asks of an engine."""

    engine: str

    def search(self, query: str, limit: int) -> Any: ...

    def listing(self, url: str, retry: int = 0) -> dict: ...

    def article(self, url: str) -> dict: ...

    def content(self, url: str) -> bytes: ...


def as_dict(answer: Any) -> dict:
    """A service's answer as a dict: an object tells its fields by ``model_dump``,
    ``dict`` or its attributes; what has none of these is no answer."""
    if answer is None or isinstance(answer, dict):
        return answer or {}
    for name in ("model_dump", "dict"):
        if callable(made := getattr(answer, name, None)):
            return made()
    return dict(vars(answer)) if hasattr(answer, "__dict__") else {}


def found_urls(answer: Any) -> list[str]:
    """SRC3: the addresses in a search answer, which has its hits under ``web``, or under
    ``web`` in ``data``; a hit is an object with ``url``, or an address."""
    whole = as_dict(answer)
    hits = whole.get("web")
    if hits is None:
        hits = as_dict(whole.get("data")).get("web")
    urls = [x if isinstance(x, str) else as_dict(x).get("url") for x in hits or ()]
    return [u for u in urls if u]


def scrape(answer: Any) -> dict:
    """A service's answer as the fields of a scrape, whichever way it spells their names."""
    own = as_dict(answer)
    own = as_dict(own["data"]) if "markdown" not in own and own.get("data") else own
    made = {n: own.get(n) for n in FIELDS}
    made["raw_html"] = own.get("raw_html") or own.get("rawHtml")
    if made["metadata"] is not None:
        made["metadata"] = {k: "; ".join(map(str, v)) if isinstance(v, list) else str(v) for k, v in as_dict(made["metadata"]).items() if v is not None}
    return made


class ServiceClient:
    """SRC3, SRC4, SRC6: a crawler service.  ``call(method, arguments)`` is its transport."""

    engine = "service"
    #: Milliseconds that a listing is waited for, and for each try more.
    wait, more = 2000, 1500

    def __init__(self, call: Callable[[str, dict], Any]):
        self.call = call

    def search(self, query: str, limit: int) -> Any:
        return self.call("search", {"query": query, "limit": limit})

    def listing(self, url: str, retry: int = 0) -> dict:
        wait = self.wait + self.more * retry
        steps = [{"type": "wait", "milliseconds": wait}, {"type": "scroll", "direction": "down"}, {"type": "wait", "milliseconds": wait}]
        return scrape(self.call("scrape", {"url": url, "formats": ["links", "html", "markdown"], "actions": steps}))

    def article(self, url: str) -> dict:
        return scrape(self.call("scrape", {"url": url, "formats": ["markdown", "html", "links"]}))

    def content(self, url: str) -> bytes:
        return self.call("download", {"url": url})


class NativeClient:
    """SRC5, SRC7: plain HTTP.  ``get(url, headers)`` returns a status and a body; fields other
    than the markup come from it later (T20-T23)."""

    engine = "native"
    headers = {"User-Agent": "Mozilla/5.0 (compatible; marlstone)"}

    def __init__(self, get: Callable[[str, dict], tuple[int, bytes]]):
        self.get = get

    def _body(self, url: str) -> bytes:
        status, body = self.get(url, self.headers)
        if status == 404:
            raise NotThere(url)
        if status >= 400:
            raise OSError(f"status {status} at {url}")
        return body

    def search(self, query: str, limit: int) -> Any:
        raise NotImplementedError("plain HTTP can't search; use the service engine")

    def listing(self, url: str, retry: int = 0) -> dict:
        """A page that isn't there is an empty one; other failures raise."""
        try:
            return {"html": self._body(url).decode("utf-8", "replace")}
        except NotThere:
            return {}

    def article(self, url: str) -> dict:
        return {"html": self._body(url).decode("utf-8", "replace")}

    def content(self, url: str) -> bytes:
        return self._body(url)


#: The engines by name.
ENGINES: dict[str, Callable[..., Client]] = {ServiceClient.engine: ServiceClient, NativeClient.engine: NativeClient}


def client(engine: str, transport: Callable) -> Client:
    if engine not in ENGINES:
        raise ValueError(f"no engine {engine}; there are {', '.join(ENGINES)}")
    return ENGINES[engine](transport)


class TableClient:
    """Answers from tables in place of a network: pages by address, listings by address and
    page number, searches by query, and contents by address."""

    engine = "table"

    def __init__(self, pages: dict[str, dict] | None = None, searches: dict[str, Any] | None = None, contents: dict[str, bytes] | None = None):
        self.pages, self.searches, self.contents = pages or {}, searches or {}, contents or {}

    def search(self, query: str, limit: int) -> Any:
        return self.searches.get(query)

    def listing(self, url: str, retry: int = 0) -> dict:
        return self.pages.get(url, {})

    def article(self, url: str) -> dict:
        if url not in self.pages:
            raise NotThere(f"no page at {url}")
        return self.pages[url]

    def content(self, url: str) -> bytes:
        if url not in self.contents:
            raise NotThere(f"nothing at {url}")
        return self.contents[url]


def landing_html(client: Client, doi: str, tries: int = 3) -> str | None:
    """SRC23: the page a DOI leads to; null after ``tries`` failures."""
    for _ in range(tries):
        try:
            return client.content(f"https://doi.org/{doi}").decode("utf-8", "replace")
        except (OSError, LookupError):
            continue
    return None
