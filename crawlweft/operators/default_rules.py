"""Media types that are read, not read, or common (fixed values)."""

from crawlweft.operators.media_types import COMMON, INDEXABLE, NON_INDEXABLE

_INDEXABLE = """
message/*
multipart/*
text/*
application/doc
application/msexcel
application/mspowerpoint
application/vnd.ms-pps
application/vnd.ms-powerpoint.presentation.12
application/ppt
application/vnd.ms-word
application/vnd.ms-word.document.12
application/vnd.wap.xhtml+xml
pdf
application/download
"""

_NON_INDEXABLE = """
audio/*
image/*
model/*
video/*
img/*
application/x-zip-compressed
application/zip
application/x-cpio
application/x-shar
application/x-sharedlib
application/x-shockwave-flash
application/x-silverlight-app
application/x-stuffit
application/x-stuffitx
application/x-sv4cpio
application/x-tar
application/x-bcpio
application/x-bzip
application/x-bzip2
application/x-compress
application/x-iso9660-image
application/x-gtar
application/x-gzip
application/vnd.adobe.air-application-installer-package+zip
application/x-xz
application/vnd.ms-cab-compressed
application/x-7z-compressed
application/x-ace-compressed
application/x-rar-compressed
application/x-uc2-compressed
application/vnd.android.package-archive
application/x-zoo
application/x-rpm
application/x-debian-package
application/x-tika-java-enterprise-archive
application/x-tika-java-web-archive
application/java-archive
application/vnd.joost.joda-archive
application/x-archive
application/x-webarchive
application/x-executable
application/x-dosexec
application/x-javascript
application/mp4
application/mpeg4-generic
application/mpeg4-iod
application/mpeg4-iod-xmt
application/ogg
application/opensearchdescription+xml
application/octet-stream
"""

_COMMON = """
application/atom+xml
application/epub+zip
application/json
application/msword
application/msword2
application/msword5
application/onenote
application/pdf
application/postscript
application/rdf+xml
application/rss+xml
application/rtf
application/sgml
application/vnd.3gpp.sms
application/vnd.3gpp2.sms
application/vnd.amazon.ebook
application/vnd.apple.iwork
application/vnd.apple.keynote
application/vnd.apple.numbers
application/vnd.apple.pages
application/vnd.lotus-1-2-3
application/vnd.lotus-approach
application/vnd.lotus-freelance
application/vnd.lotus-notes
application/vnd.lotus-organizer
application/vnd.lotus-screencam
application/vnd.lotus-wordpro
application/vnd.ms-excel
application/vnd.ms-excel.addin.macroenabled.12
application/vnd.ms-excel.sheet.binary.macroenabled.12
application/vnd.ms-excel.sheet.macroenabled.12
application/vnd.ms-excel.template.macroenabled.12
application/vnd.ms-htmlhelp
application/vnd.ms-outlook
application/vnd.ms-powerpoint
application/vnd.ms-powerpoint.addin.macroenabled.12
application/vnd.ms-powerpoint.presentation.macroenabled.12
application/vnd.ms-powerpoint.slide.macroenabled.12
application/vnd.ms-powerpoint.slideshow.macroenabled.12
application/vnd.ms-powerpoint.template.macroenabled.12
application/vnd.ms-project
application/vnd.ms-word.document.macroenabled.12
application/vnd.ms-word.template.macroenabled.12
application/vnd.ms-works
application/vnd.ms-xpsdocument
application/vnd.oasis.opendocument.chart
application/vnd.oasis.opendocument.chart-template
application/vnd.oasis.opendocument.database
application/vnd.oasis.opendocument.formula
application/vnd.oasis.opendocument.formula-template
application/vnd.oasis.opendocument.graphics
application/vnd.oasis.opendocument.graphics-template
application/vnd.oasis.opendocument.image
application/vnd.oasis.opendocument.image-template
application/vnd.oasis.opendocument.presentation
application/vnd.oasis.opendocument.presentation-template
application/vnd.oasis.opendocument.spreadsheet
application/vnd.oasis.opendocument.spreadsheet-template
application/vnd.oasis.opendocument.text
application/vnd.oasis.opendocument.text-master
application/vnd.oasis.opendocument.text-template
application/vnd.oasis.opendocument.text-web
application/vnd.openxmlformats-officedocument.presentationml.presentation
application/vnd.openxmlformats-officedocument.presentationml.slide
application/vnd.openxmlformats-officedocument.presentationml.slideshow
application/vnd.openxmlformats-officedocument.presentationml.template
application/vnd.openxmlformats-officedocument.spreadsheetml.sheet
application/vnd.openxmlformats-officedocument.spreadsheetml.template
application/vnd.openxmlformats-officedocument.wordprocessingml.document
application/vnd.openxmlformats-officedocument.wordprocessingml.template
application/vnd.wordperfect
application/winhlp
application/wordperfect5.1
application/x-corelpresentations
application/x-latex
application/x-mobipocket-ebook
application/x-ms-application
application/x-msaccess
application/x-msmoney
application/x-mspublisher
application/x-msschedule
application/x-msterminal
application/x-mswrite
application/x-quattro-pro
application/x-tex
application/x-tex-tfm
application/x-texinfo
application/x-tika-iworks-protected
application/x-tika-msoffice
application/x-tika-msoffice-embedded
application/x-tika-msoffice-embedded; format=comp_obj
application/x-tika-msoffice-embedded; format=ole10_native
application/x-tika-msworks-spreadsheet
application/x-tika-ooxml
application/x-tika-ooxml-protected
application/xhtml+xml
application/xhtml-voice+xml
application/xml
application/xmpp+xml
message/rfc822
text/csv
text/html
text/plain
text/rfc822-headers
text/richtext
text/sgml
text/tab-separated-values
text/vnd.latex-z
text/x-asciidoc
text/x-ini
text/x-lex
text/x-log
text/x-vcalendar
text/x-vcard
text/x-yaml
application/opensearchdescription+xml
application/octet-stream
application/doc
application/msexcel
application/mspowerpoint
application/ppt
application/vnd.ms-word
application/vnd.ms-word.document.12
application/vnd.wap.xhtml+xml
pdf
application/vnd.ms-pps
application/vnd.ms-powerpoint.presentation.12
application/download
"""

SECTIONS = {
    INDEXABLE: _INDEXABLE.strip().splitlines(),
    NON_INDEXABLE: _NON_INDEXABLE.strip().splitlines(),
    COMMON: _COMMON.strip().splitlines(),
}
