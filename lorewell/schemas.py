"""Record types of the sources and results."""

from __future__ import annotations

CATEGORY_LINK = "page_id long, category string, cl_type string"
PAGE = "page_id long, title string, namespace int, is_redirect boolean"
ENTITY = "qid long, title string, label string, sitelinks int, aliases array<string>, claims map<int,array<long>>"
RANK = "qid long, qrank long"
WORD_VECTOR = "name string, is_entity boolean, vector array<double>"

#: Property numbers, the category namespace and the category title's prefix.
INSTANCE_OF, SUBCLASS_OF = 31, 279
CATEGORY_NAMESPACE = 14
CATEGORY_PREFIX = "Category:"
