"""Language codes of ISO 639: the two-letter codes with their three-letter ones, and the bibliographic variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ISO 639-1 code and ISO 639-3 (639-2/T) code of each language that has both, in order of the first. Fixed values.
_PAIRS = """
aa aar ab abk ae ave af afr ak aka am amh an arg ar ara as asm av ava ay aym az aze ba bak be bel bg bul bi bis bm bam bn ben bo bod br bre bs bos
ca cat ce che ch cha co cos cr cre cs ces cu chu cv chv cy cym da dan de deu dv div dz dzo ee ewe el ell en eng eo epo es spa et est eu eus
fa fas ff ful fi fin fj fij fo fao fr fra fy fry ga gle gd gla gl glg gn grn gu guj gv glv ha hau he heb hi hin ho hmo hr hrv ht hat hu hun hy hye hz her
ia ina id ind ie ile ig ibo ii iii ik ipk io ido is isl it ita iu iku ja jpn jv jav ka kat kg kon ki kik kj kua kk kaz kl kal km khm kn kan ko kor kr kau ks kas ku kur kv kom kw cor ky kir
la lat lb ltz lg lug li lim ln lin lo lao lt lit lu lub lv lav mg mlg mh mah mi mri mk mkd ml mal mn mon mr mar ms msa mt mlt my mya
na nau nb nob nd nde ne nep ng ndo nl nld nn nno no nor nr nbl nv nav ny nya oc oci oj oji om orm or ori os oss pa pan pi pli pl pol ps pus pt por qu que
rm roh rn run ro ron ru rus rw kin sa san sc srd sd snd se sme sg sag sh hbs si sin sk slk sl slv sm smo sn sna so som sq sqi sr srp ss ssw st sot su sun sv swe sw swa
ta tam te tel tg tgk th tha ti tir tk tuk tl tgl tn tsn to ton tr tur ts tso tt tat tw twi ty tah ug uig uk ukr ur urd uz uzb ve ven vi vie vo vol
wa wln wo wol xh xho yi yid yo yor za zha zh zho zu zul
""".split()
TWO = dict(zip(_PAIRS[::2], _PAIRS[1::2]))
#: Withdrawn two-letter codes that labels still carry. Fixed values.
OLD = {"in": "ind", "iw": "heb", "ji": "yid", "jw": "jav", "mo": "ron"}
#: ISO 639-2/B codes that differ from 639-3. Fixed values.
BIBLIOGRAPHIC = {"alb": "sqi", "arm": "hye", "baq": "eus", "bur": "mya", "chi": "zho", "cze": "ces", "dut": "nld", "fre": "fra", "geo": "kat", "ger": "deu", "gre": "ell", "ice": "isl", "mac": "mkd", "mao": "mri", "may": "msa", "per": "fas", "rum": "ron", "slo": "slk", "tib": "bod", "wel": "cym"}
#: Codes for no, several or an uncoded language, and what is written where the language isn't known. Fixed values.
PLACEHOLDERS = ("und", "mis", "mul", "zxx", "unk", "xxx")


def primary(label: Column) -> Column:
    """The code before a region or script of a well-formed label, in small letters; '' where it is none."""
    return F.lower(F.regexp_extract(F.trim(label), "^([A-Za-z]{2,3})(?:[-_][A-Za-z0-9]+)*$", 1))


def language(label: Column) -> Column:
    """The ISO 639-3 code a label names, else null. A code of three letters names a language unless it is a placeholder or
    one reserved for private use (qaa to qtz); whether it is assigned isn't looked up."""
    code = primary(label)
    table = F.create_map(*(F.lit(x) for kv in (TWO | OLD | BIBLIOGRAPHIC).items() for x in kv))
    three = (F.length(code) == 3) & ~code.isin(*PLACEHOLDERS) & ~code.rlike("^q[a-t][a-z]$")
    return F.coalesce(F.try_element_at(table, code), F.when(three, code))
