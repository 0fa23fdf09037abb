"""Ways to fetch one page. A transport is called with the request's parameters
and returns a ``Reply``; it travels to the workers, so it must be picklable."""

from __future__ import annotations

import http.client
import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Mapping
from dataclasses import dataclass, field

OK = 200


@dataclass(frozen=True)
class Reply:
    status: int
    body: str


@dataclass(frozen=True)
class HttpGet:
    """GET with the parameters as query string. A broken answer is an ``OSError``."""

    url: str
    headers: Mapping[str, str] = field(default_factory=dict, repr=False)
    timeout: float = 60

    def __call__(self, params: Mapping) -> Reply:
        query = urllib.parse.urlencode({k: v for k, v in params.items() if v is not None})
        request = urllib.request.Request(f"{self.url}?{query}", headers=dict(self.headers))
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as response:
                return Reply(response.status, response.read().decode("utf-8"))
        except urllib.error.HTTPError as error:
            return Reply(error.code, "")
        except http.client.HTTPException as error:
            raise ConnectionError(f"broken answer: {error!r}") from error


@dataclass
class RecordedPages:
    """Pages stored as files of JSON lines, one page per line.

    The files of a request lie in ``{root}/{name}={value}``, after the one
    parameter that tells requests apart (or in ``root`` without one). A line is
    ``{"page": 1, "items": [...]}``; a page that is not there is empty. The root
    is a folder that all workers see. A task holds the pages of one request.

    With ``block`` above 0 the pages of a request are parted into folders of that
    many, ``block=0`` holding those from 1 on. A task then reads and holds the pages of one block,
    however many the request has.
    """

    root: str
    name: str | None = None
    page_param: str = "pagina"
    block: int = 0
    _folder: str | None = field(default=None, init=False, repr=False)
    _pages: dict[int, str] = field(default_factory=dict, init=False, repr=False)

    def __call__(self, params: Mapping) -> Reply:
        folder = f"{self.root}/{self.name}={params[self.name]}" if self.name else self.root
        wanted = int(params.get(self.page_param) or 1)
        if self.block:
            folder = f"{folder}/block={(wanted - 1) // self.block}"
        if folder != self._folder:
            self._folder, self._pages = folder, dict(_recorded(folder))
        return Reply(OK, self._pages.get(wanted, "[]"))


def _recorded(folder: str):
    from pyarrow import fs

    location = folder.replace("s3a://", "s3://") if "://" in folder else "file://" + folder.removeprefix("file:")
    filesystem, path = fs.FileSystem.from_uri(location)
    listing = filesystem.get_file_info(fs.FileSelector(path, allow_not_found=True))
    for entry in listing:
        if entry.is_file and not entry.base_name.startswith(("_", ".")):
            with filesystem.open_input_stream(entry.path) as stream:
                for line in stream.read().decode("utf-8").split("\n"):
                    if line.strip():
                        # The items stand last, so they are taken over as they were recorded.
                        head, _, items = line.partition('"items":')
                        yield json.loads(head.rstrip().rstrip(",") + "}")["page"], items.strip()[:-1]
