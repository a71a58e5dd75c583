from amity.operators.accesses import (
    access_stats,
    merged_access_stats,
    page_bitmaps,
    top_pages,
    visits_per_page,
)
from amity.operators.activity import inactive_users, inactive_users_minutes, latest_access
from amity.operators.friends import (
    owners_visiting_no_friend,
    owners_visiting_no_friend_merged,
    owners_with_unvisited_friend,
    relationship_counts,
    unvisited_friend_pairs,
)
from amity.operators.ordering import ordered
from amity.operators.popularity import owner_degree_profiles, owner_degrees, popularity_labels
from amity.operators.quality import (
    contract_violations,
    observed_quality,
    record_quality,
    rejected_records,
    routed_records,
    row_counts,
)
from amity.operators.users import (
    users_by_nationality,
    users_per_country_code,
    users_per_nationality,
)

__all__ = [
    "access_stats",
    "contract_violations",
    "inactive_users",
    "inactive_users_minutes",
    "latest_access",
    "merged_access_stats",
    "observed_quality",
    "ordered",
    "owner_degree_profiles",
    "owner_degrees",
    "owners_visiting_no_friend",
    "owners_visiting_no_friend_merged",
    "owners_with_unvisited_friend",
    "page_bitmaps",
    "popularity_labels",
    "record_quality",
    "rejected_records",
    "relationship_counts",
    "routed_records",
    "row_counts",
    "top_pages",
    "unvisited_friend_pairs",
    "users_by_nationality",
    "users_per_country_code",
    "users_per_nationality",
    "visits_per_page",
]
