"""Registry of license registers: where a file is, how to read it, how its columns map."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.session import shuffled
from placemill.sources.inline import NUMBER, TEXT, TEXT_LIST, TEXT_MAP, inline_relation

CSV_FORMATS = ("csv", "fas")
FORMATS = (*CSV_FORMATS, "excel")


@dataclass(frozen=True)
class SourceSpec:
    """One register. ``header_row`` counts from 0; ``sheet`` is a position or a name."""

    id: str
    pref: str
    muni: str
    route: str
    source_name: str
    license: str
    format: str
    path: str
    url: str = ""
    encoding: str | None = None
    header_row: int = 0
    sheet: int | str = 0
    const: Mapping[str, str] = field(default_factory=dict)
    colmap: Mapping[str, str] = field(default_factory=dict)
    address_parts: Sequence[str] = ()

    def __post_init__(self):
        if self.format not in FORMATS:
            raise ValueError(f"unknown format: {self.format}")


REGISTRY_COLUMNS = {
    "source_id": TEXT, "source_rank": NUMBER, "pref": TEXT, "muni": TEXT, "route": TEXT, "source_name": TEXT,
    "license": TEXT, "format": TEXT, "path": TEXT, "url": TEXT, "encoding": TEXT, "header_row": NUMBER, "sheet": TEXT,
    "const": TEXT_MAP, "colmap": TEXT_MAP, "address_parts": TEXT_LIST,
}


def registry_frame(spark: SparkSession, specs: Sequence[SourceSpec] | DataFrame) -> DataFrame:
    """The registry as a relation; ``source_rank`` keeps the order sources are listed in. One that grows with the data is
    a table of these columns to begin with."""
    if isinstance(specs, DataFrame):
        return specs
    return inline_relation(spark, REGISTRY_COLUMNS, [
        (s.id, rank, s.pref, s.muni, s.route, s.source_name, s.license, s.format, s.path, s.url, s.encoding,
         s.header_row, f"#{s.sheet}" if isinstance(s.sheet, int) else s.sheet,
         list(s.const.items()), list(s.colmap.items()), list(s.address_parts))
        for rank, s in enumerate(specs)
    ])


def registry_side(specs: Sequence[SourceSpec] | DataFrame, registry: DataFrame) -> DataFrame:
    """What a registry holds, as a side of a join: the caller's own list is sent to every task, a table is shuffled."""
    return shuffled(registry) if isinstance(specs, DataFrame) else F.broadcast(registry)


def path_key(path):
    """A file path without scheme and host, to match listed files to the registry."""
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?)?/*", "/")


# --- fixed values: shared column mapping of the national system, and the known registers -------
NATIONAL_COLUMNS = {
    "prefecture": "都道府県名",
    "city": "市区町村名",
    "name": "営業施設名称、屋号又は商号",
    "name_kana": "営業施設名称、屋号又は商号（フリガナ）",
    "business_type": "営業の種類",
    "lat": "緯度",
    "lng": "経度",
    "phone": "営業施設電話番号",
    "license_no": "許可番号",
    "license_date": "許可年月日",
    "expire_date": "許可満了日",
}
NATIONAL_ADDRESS = ("営業施設所在地", "営業施設方書")
NATIONAL_NAME = "厚生労働省 食品衛生申請等システム（オープンデータ）"
NATIONAL_LICENSE = "公共データ利用規約（第1.0版, PDL1.0）"
NATIONAL_URL = "https://i2fas.mhlw.go.jp/faspub/IO_S010303.do?method=a_menu_o01Action"


def _national(id: str, pref: str, muni: str, folder: str, code: str) -> SourceSpec:
    return SourceSpec(
        id, pref, muni, "i2fas", NATIONAL_NAME, NATIONAL_LICENSE, "fas",
        f"{folder}/{code}_food_business_all.csv", NATIONAL_URL, "utf-8-sig",
        colmap=NATIONAL_COLUMNS, address_parts=NATIONAL_ADDRESS,
    )


def known_registers(folder: str) -> list[SourceSpec]:
    """The registers the area report is about, with their files in ``folder``."""
    return [
        SourceSpec(
            "minato", "東京都", "港区", "自身", "東京都港区 食品営業許可（オープンデータ）", "CC BY 4.0",
            "csv", f"{folder}/minato.csv",
            "https://opendata.city.minato.tokyo.jp/dataset/54d8c582-00e2-4730-a23f-4a5befec9ae5/resource/c9d0299e-8e05-4317-877f-83055709e41f/download/food_business_all.csv",
            "utf-8-sig",
            colmap={
                "prefecture": "施設所在地_都道府県", "city": "施設所在地_市区町村", "city_raw": "地方公共団体名",
                "name": "施設名称", "name_kana": "施設名称_カナ", "business_type": "営業の種類",
                "lat": "緯度", "lng": "経度", "phone": "施設電話番号", "license_no": "許可番号",
                "license_date": "許可年月日", "expire_date": "許可満了日",
            },
            address_parts=("所在地_連結表記",),
        ),
        SourceSpec(
            "kobe", "兵庫県", "神戸市", "自身", "神戸市食品営業許可施設一覧", "CC BY 4.0",
            "csv", f"{folder}/kobe.csv",
            "https://www.city.kobe.lg.jp/documents/6359/20260407150739.csv", "cp932",
            const={"prefecture": "兵庫県", "city": "神戸市", "city_raw": "神戸市"},
            colmap={
                "name": "屋号", "business_type": "業種情報公開名称", "phone": "営業所ＴＥＬ１",
                "license_no": "許可番号", "license_date": "許可決定日", "expire_date": "許可満了日",
            },
            address_parts=("営業所所在地", "営業所方書"),
        ),
        SourceSpec(
            "hyogo", "兵庫県", "(県所管域)", "管轄主体", "兵庫県食品関係営業施設リスト（許可）", "CC BY 4.0",
            "excel", f"{folder}/hyogo.xlsx",
            "https://web.pref.hyogo.lg.jp/kf14/documents/000028_food_business_lisence_all.xlsx",
            header_row=1, const={"prefecture": "兵庫県"},
            colmap={
                "name": "営業所名称", "business_type": "業種", "phone": "営業所電話番号",
                "license_no": "許可番号", "license_date": "許可日", "expire_date": "有効期限",
            },
            address_parts=("営業所所在地",),
        ),
        SourceSpec(
            "bodik_maebashi", "群馬県", "前橋市", "自身", "前橋市 食品等営業許可・届出一覧（BODIK）", "CC BY 4.0",
            "excel", f"{folder}/bodik_maebashi.xlsx",
            "https://data.bodik.jp/dataset/be0e8464-4b96-41f6-901d-1aa4bf11bcc0",
            const={"prefecture": "群馬県", "city": "前橋市", "city_raw": "前橋市"},
            colmap={
                "name": "営業所名", "business_type": "営業の種類", "license_no": "許可番号",
                "license_date": "許可年月日", "expire_date": "許可満了日",
            },
            address_parts=("営業所所在地",),
        ),
        _national("fas_maebashi", "群馬県", "前橋市", folder, "10201"),
        _national("fas_kobe", "兵庫県", "神戸市", folder, "28100"),
        _national("fas_hyogo", "兵庫県", "(県所管域)", folder, "28000"),
        _national("fas_hakodate", "北海道", "函館市", folder, "01202"),
    ]


# fixed values: areas of the match report, the registers they draw on, the count compared with
KNOWN_AREAS = (
    ("前橋市", ("bodik_maebashi", "fas_maebashi"), 5370),
    ("神戸市", ("kobe", "fas_kobe"), 29795),
    ("兵庫県所管域", ("hyogo", "fas_hyogo"), 34529),
    ("港区", ("minato",), None),
    ("函館市", ("fas_hakodate",), None),
)
