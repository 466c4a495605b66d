"""Career sites as a Spark data source: one partition per site, each read completely or not at all.

    spark.dataSource.register(CareerSiteSource)
    spark.read.format("career_site").option("sites", json).load()

``sites`` is a JSON list of source configurations (registry.SOURCE). Each site gives one row: its payload as it is stored,
with digest and counts, or its error, so a failing site doesn't end the run. The payload of a board is its answer; that of
a site with pages is a bundle: the listing pages and the posting pages with their digests, and what the listing says of each.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vacantia.functions.html import listed_postings, parse
from vacantia.functions.text import canonical_json

SCHEMA = (
    "provider string, name string, token string, employer_id string, endpoint string, http_status int, content_type string, content_sha256 string, byte_count long, "
    "source_job_count long, listing_page_count long, detail_page_count long, collected_at timestamp, payload binary, error string"
)
AGENT = "vacantia (job-posting statistics; see the repository)"


class SiteError(Exception):
    """A site's answer breaks its contract."""


@dataclass
class Answer:
    raw: bytes
    url: str
    status: int = 200
    content_type: str = ""

    def json(self) -> object:
        try:
            return json.loads(self.raw)
        except ValueError as e:
            raise SiteError(f"no JSON: {self.url}") from e

    def object(self) -> dict:
        if not isinstance(value := self.json(), dict):
            raise SiteError(f"object expected: {self.url}")
        return value


#: fetch(url, body, as_form): GET without a body, else POST of it as JSON or as a form.
Fetch = Callable[[str, dict | None, bool], Answer]


def http_fetch(timeout: float = 30.0) -> Fetch:
    """Requests over https only."""
    def fetch(url: str, body: dict | None = None, as_form: bool = False) -> Answer:
        if not url.startswith("https://"):
            raise SiteError(f"not https: {url}")
        data = None if body is None else urllib.parse.urlencode(body).encode() if as_form else json.dumps(body).encode()
        headers = {"Accept": "application/json, text/html", "User-Agent": AGENT} | ({"Content-Type": "application/json"} if data and not as_form else {})
        with urllib.request.urlopen(urllib.request.Request(url, data, headers), timeout=timeout) as a:
            return Answer(a.read(), a.geturl(), a.status, a.headers.get("Content-Type", ""))

    return fetch


@dataclass
class Listing:
    """What one listing page says: its answer, {posting: what is said of it}, the announced total, whether more pages follow (None: not said)."""

    answer: Answer
    asked: str
    found: dict[str, dict]
    total: int | None = None
    more: bool | None = None
    request: dict = field(default_factory=dict)


@dataclass
class Payload:
    endpoint: str
    raw: bytes
    jobs: int
    status: int = 200
    content_type: str = "application/json"
    listing_pages: int | None = None
    detail_pages: int | None = None


def _get(url: str, **values: object) -> str:
    return url + ("&" if "?" in url else "?") + urllib.parse.urlencode(values)


def _need(site: dict, *names: str) -> None:
    if missing := [n for n in names if not site.get(n)]:
        raise SiteError(f"source lacks {', '.join(missing)}")


def walk(site: dict, page: Callable[[int], Listing], step: int = 1) -> tuple[list[Listing], dict[str, dict], int | None]:
    """Listing pages until the announced total is there or no more are said to follow; (pages, postings, total).

    Errors: a total that changes or isn't met, a page without new postings while more must come, and more pages than
    max_pages. Where neither total nor an end is announced, an empty page is the end. Nothing is cut short in silence.
    """
    pages: list[Listing] = []
    found: dict[str, dict] = {}
    total = None
    for k in range(site.get("max_pages") or 20):
        now = page(k * step)
        total = now.total if total is None else total
        if now.total is not None and now.total != total:
            raise SiteError(f"total changed from {total} to {now.total}")
        pages.append(now)
        before = len(found)
        for posting, said in now.found.items():
            found.setdefault(posting, said)
        if now.more is False or (total is not None and len(found) >= total) or (total is None and now.more is None and not now.found):
            break
        if len(found) == before:
            raise SiteError("a page without new postings")
    else:
        raise SiteError(f"more than {site.get('max_pages') or 20} pages")
    if total is not None and len(found) != total:
        raise SiteError(f"{len(found)} of {total} postings")
    return pages, found, total


def _record(answer: Answer, asked: str, **more: object) -> dict:
    return {"requested_url": asked, "final_url": answer.url, "status_code": answer.status, "content_type": answer.content_type, "content_sha256": hashlib.sha256(answer.raw).hexdigest(), "body_base64": base64.b64encode(answer.raw).decode()} | more


def bundle(site: dict, endpoint: str, pages: list[Listing], found: dict[str, dict], address: Callable[[str], str], fetch: Fetch, own: Callable[[str, dict], dict], is_json: bool, **said: object) -> Payload:
    """Every posting's page, after the site's delay, and all of it as one canonical JSON payload."""
    details = []
    for posting, index in found.items():
        if delay := site.get("request_delay_seconds"):
            time.sleep(delay)
        answer = fetch(address(posting), None, False)
        if is_json:
            answer.object()
        details.append(_record(answer, address(posting), **own(posting, index)))
    value = {
        "provider": site["provider"], "source_token": site["token"], "listing_url": endpoint, "reported_job_count": len(found), **said,
        "listing_pages": [_record(p.answer, p.asked, **({"request": p.request} if p.request else {})) for p in pages], "job_index": list(found.values()), "job_pages": details,
    }
    kind = f"application/vnd.vacantia.{site['provider'].replace('_', '-')}+json"
    return Payload(endpoint, canonical_json(value), len(found), content_type=kind, listing_pages=len(pages), detail_pages=len(details))


def board(site: dict, fetch: Fetch) -> Payload:
    """One request; the payload must have a list of jobs."""
    url = _get(site.get("api_url") or f"https://boards-api.greenhouse.io/v1/boards/{site['token']}/jobs", content="true")
    answer = fetch(url, None, False)
    jobs = answer.object().get("jobs")
    if not isinstance(jobs, list):
        raise SiteError("no list of jobs")
    return Payload(answer.url, answer.raw, len(jobs), answer.status, answer.content_type)


def postings(site: dict, fetch: Fetch) -> Payload:
    """One request up to a limit; a second one past the end proves that nothing was held back."""
    limit, base = site.get("page_size") or 500, site.get("api_url") or f"https://api.lever.co/v0/postings/{site['token']}"
    answer = fetch(_get(base, mode="json", limit=limit), None, False)
    jobs = answer.json()
    if not isinstance(jobs, list) or not all(isinstance(j, dict) for j in jobs) or len(jobs) >= limit:
        raise SiteError("no list of postings, or the limit is reached")
    if jobs:
        rest = fetch(_get(base, mode="json", skip=len(jobs), limit=1), None, False).json()
        if not isinstance(rest, list) or rest:
            raise SiteError("the site holds postings back")
    return Payload(answer.url, answer.raw, len(jobs), answer.status, answer.content_type)


def html_listing(site: dict, fetch: Fetch) -> Payload:
    """HTML listing with a banner "Results x - y of z" and rows with links to postings."""
    _need(site, "listing_url")
    base = urllib.parse.urlsplit(site["listing_url"])

    def page(offset: int) -> Listing:
        url = site["listing_url"] if not offset else base._replace(path=f"{base.path.rstrip('/')}/{offset}/").geturl()
        answer = fetch(url, None, False)
        text = answer.raw.decode("utf-8", "replace")
        banner = re.search(r"(?i)results\s+\d+\s*[-–—]\s*\d+\s+of\s+([\d,]+)", parse(text).text())
        if not banner:
            raise SiteError("the listing doesn't say how many results it has")
        return Listing(answer, url, {p["application_url"]: p for p in listed_postings(text, answer.url)}, int(banner[1].replace(",", "")))

    pages, found, _ = walk(site, page, site.get("page_size") or 25)
    return bundle(site, site["listing_url"], pages, found, lambda url: url, fetch, lambda _, index: {"source_job_id": index["source_job_id"]}, False)


def posted_listing(site: dict, fetch: Fetch) -> Payload:
    """JSON listing by POST with offset and limit, whose total is a must; postings are told apart by their external path."""
    _need(site, "host", "tenant", "site")
    size, host = site.get("page_size") or 20, site["host"].rstrip("/")
    base = f"{host}/wday/cxs/{site['tenant']}/{site['site']}"

    def page(offset: int) -> Listing:
        body = {"appliedFacets": {}, "limit": size, "offset": offset, "searchText": ""}
        answer = fetch(f"{base}/jobs", body, False)
        value = answer.object()
        total, listed = value.get("total"), value.get("jobPostings")
        if type(total) is not int or total < 0 or not isinstance(listed, list):
            raise SiteError("no total, or no list of postings")
        found = {str(p.get("externalPath") or p.get("external_path") or p.get("url") or "") if isinstance(p, dict) else "": p for p in listed}
        if "" in found:
            raise SiteError("a posting without its path")
        return Listing(answer, f"{base}/jobs", found, total, request=body)

    pages, found, _ = walk(site, page, size)
    return bundle(site, f"{base}/jobs", pages, found, lambda path: f"{base}/{path.lstrip('/')}", fetch, lambda path, _: {"external_path": path}, True, public_base_url=f"{host}/en-US/{site['site']}")


# Fields that name a requisition.
_REQUISITION_IDS = ("Id", "ID", "RequisitionId", "RequisitionNumber", "requisitionNumber")


def requisitions(site: dict, fetch: Fetch) -> Payload:
    """REST listing by offset, its total optional; hasMore says whether pages follow, also beside a total."""
    _need(site, "host", "site")
    size, host = site.get("page_size") or 25, site["host"].rstrip("/")
    root = f"{host}/hcmRestApi/resources/latest"

    def page(offset: int) -> Listing:
        asked = {"finder": f"findReqs;siteNumber={site['site']}", "limit": size, "offset": offset, "onlyData": "true"}
        answer = fetch(_get(f"{root}/recruitingCEJobRequisitions", **asked), None, False)
        value = answer.object()
        items = value.get("items")
        if not isinstance(items, list) or not all(isinstance(i, dict) for i in items):
            raise SiteError("no list of items")
        # Some sites wrap the requisitions into one item with their number.
        inner = [r for i in items for r in (i["requisitionList"] if isinstance(i.get("requisitionList"), list) else [i])]
        total = next((x for x in (value.get("totalResults"), value.get("total"), *(i.get("TotalJobsCount") for i in items)) if x is not None), None)
        if total is not None and (type(total) is not int or total < 0):
            raise SiteError("the total is no number")
        found = {str(next((r[k] for k in _REQUISITION_IDS if r.get(k) not in (None, "")), "")): r for r in inner}
        if "" in found:
            raise SiteError("a requisition without an id")
        more = value.get("hasMore")
        return Listing(answer, f"{root}/recruitingCEJobRequisitions", found, total, more if isinstance(more, bool) else None, asked)

    pages, found, _ = walk(site, page, size)
    detail = lambda key: _get(f"{root}/recruitingCEJobRequisitionDetails/{urllib.parse.quote(key, safe='')}", onlyData="true")
    return bundle(site, f"{root}/recruitingCEJobRequisitions", pages, found, detail, fetch, lambda key, _: {"source_job_id": key}, True, public_base_url=f"{host}/hcmUI/CandidateExperience/en/sites/{site['site']}/job")


def ajax_listing(site: dict, fetch: Fetch) -> Payload:
    """Pages of HTML in JSON, by a form, with the number of pages; that number must not change."""
    _need(site, "listing_url", "api_url")
    seen = {"pages": 0, "jobs": False}

    def page(k: int) -> Listing:
        form = {"action": "get_listings", "search_keywords": "", "search_location": "", "filter_job_type[]": "", "per_page": site.get("page_size") or 100, "page": k + 1, "orderby": "featured", "order": "DESC", "show_pagination": "false"}
        answer = fetch(site["api_url"], form, True)
        value = answer.object()
        data = value.get("data")
        if value.get("success") is not True or not isinstance(data, dict) or not isinstance(data.get("html"), str) or not str(data.get("max_num_pages") or 0).isdigit():
            raise SiteError("the listing request failed")
        number = int(data.get("max_num_pages") or 0)
        if k and number and number != seen["pages"]:
            raise SiteError(f"pages changed from {seen['pages']} to {number}")
        seen["pages"], seen["jobs"] = seen["pages"] if k else max(number, 1), seen["jobs"] or bool(data.get("found_jobs"))
        found = {p["application_url"]: p for p in listed_postings(data["html"], site["listing_url"], "/jobs/")}
        return Listing(answer, site["api_url"], found, None, k + 1 < seen["pages"], form)

    pages, found, _ = walk(site, page)
    if seen["jobs"] and not found:
        raise SiteError("jobs are reported, but there are no links")
    return bundle(site, site["listing_url"], pages, found, lambda url: url, fetch, lambda _, index: {"source_job_id": index["source_job_id"]}, False, api_url=site["api_url"], reported_page_count=seen["pages"])


READERS: dict[str, Callable[[dict, Fetch], Payload]] = {"greenhouse": board, "lever": postings, "successfactors": html_listing, "workday": posted_listing, "oracle_hcm": requisitions, "wp_job_manager": ajax_listing}


def read_site(site: dict, fetch: Fetch, now: datetime | None = None) -> tuple:
    """The row of a site: its payload, or its error."""
    who = (site.get("provider"), site.get("name") or site.get("token"), site.get("token"), site.get("employer_id"))
    at = now or datetime.now(UTC)
    try:
        p = READERS[site["provider"]](site, fetch)
    except Exception as e:  # noqa: BLE001 - a site's failure of any kind is its result
        return (*who, site.get("listing_url") or site.get("api_url") or site.get("host"), None, None, None, None, 0, None, None, at, None, f"{type(e).__name__}: {e}")
    return (*who, p.endpoint, p.status, p.content_type, hashlib.sha256(p.raw).hexdigest(), len(p.raw), p.jobs, p.listing_pages, p.detail_pages, at, p.raw, None)


class CareerSiteSource(DataSource):
    """Options: sites, timeout in seconds, collected_at (ISO; one time for all sites of a run)."""

    @classmethod
    def name(cls) -> str:
        return "career_site"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        at = self.options.get("collected_at")
        return _Reader(json.loads(self.options["sites"]), float(self.options.get("timeout", "30")), datetime.fromisoformat(at) if at else None)


class _Reader(DataSourceReader):
    def __init__(self, sites: list[dict], timeout: float, now: datetime | None) -> None:
        self.sites, self.timeout, self.now = sites, timeout, now

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in range(len(self.sites))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield read_site(self.sites[partition.value], http_fetch(self.timeout), self.now)
