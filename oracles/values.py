"""Expected values, stated here on their own and never taken from the engine.

Fixed values: lists, limits and names the results must show.
"""

from __future__ import annotations

import regex

# Polarity and subjectivity of opinion words.
OPINION_WORDS = {(1.0, 1.0): ('excellent', 'perfect', 'wonderful', 'excelente', 'perfeito', 'parfait'),
 (0.7, 0.6): ('good', 'great', 'nice', 'bom', 'boa', 'bien', 'gut', 'bueno'),
 (0.5, 0.5): ('fast', 'quick', 'recommend', 'love', 'super', 'rapide', 'schnell'),
 (-0.5, 0.5): ('slow', 'late', 'problem', 'damaged', 'atrasado', 'lent', 'tarde'),
 (-0.7, 0.7): ('bad', 'poor', 'ruim', 'mauvais', 'schlecht', 'malo'),
 (-1.0, 1.0): ('terrible', 'awful', 'horrible', 'worst', 'pessimo', 'schrecklich')}

# Frequent function words by language.
STOP_WORDS = {'de': ('der', 'die', 'das', 'und', 'ist', 'nicht', 'ein', 'eine', 'mit', 'von', 'zu'),
 'en': ('the', 'and', 'of', 'to', 'is', 'in', 'that', 'it', 'for', 'was', 'with'),
 'es': ('el', 'los', 'las', 'y', 'una', 'por', 'con', 'para', 'del', 'como', 'que'),
 'fr': ('le', 'les', 'et', 'des', 'une', 'est', 'pour', 'dans', 'pas', 'vous', 'du'),
 'pt': ('o', 'os', 'uma', 'não', 'com', 'muito', 'produto', 'do', 'da', 'em', 'foi')}

WORD_BREAK = '[^\\p{L}]+'

# Fields that may hardly be null.
CRITICAL = {'orders': ('order_id', 'customer_id', 'order_purchase_timestamp', 'order_status'),
 'order_items': ('order_id', 'product_id', 'price'),
 'customers': ('customer_id', 'customer_city', 'customer_state'),
 'products': ('product_id',),
 'payments': ('order_id',),
 'reviews': ('review_id', 'order_id')}

# Lowest and highest value of a column.
RANGES = {'order_items': {'price': (0, 100000), 'freight_value': (0, 500)},
 'payments': {'payment_value': (0, 100000)},
 'reviews': {'review_score': (1, 5)}}

ORDER_TIMES = ('order_purchase_timestamp', 'order_approved_at', 'order_delivered_carrier_date',
 'order_delivered_customer_date', 'order_estimated_delivery_date')

REVIEW_TEXTS = ('review_comment_title', 'review_comment_message')

PROFILED_FIELDS = {'orders': ('order_id', 'customer_id', 'order_purchase_timestamp', 'order_status'),
 'order_items': ('order_id', 'product_id', 'seller_id', 'price', 'freight_value'),
 'customers': ('customer_id', 'customer_city', 'customer_state'),
 'products': ('product_id', 'product_category_name')}

KEYS = {'orders': ('order_id',),
 'order_items': ('order_id', 'order_item_id'),
 'customers': ('customer_id',),
 'products': ('product_id',)}

REQUIRED_COLUMNS = {'dim_time': ('date_id', 'year', 'month'),
 'fact_order_items': ('order_id', 'order_item_id', 'product_id', 'seller_id', 'customer_id',
                      'order_purchase_date', 'price', 'freight_value', 'total_value',
                      'order_purchase_timestamp', 'etl_loaded_at')}

# Quarter scores that name a segment.
EXACT_SEGMENTS = {(4, 4, 4): 'Champions',
 (3, 4, 4): 'Loyal Customers',
 (4, 3, 3): 'Potential Loyalists',
 (4, 1, 1): 'New Customers',
 (1, 4, 4): 'At Risk',
 (1, 3, 3): 'Need Attention',
 (1, 1, 1): 'Lost'}

# Lowest and highest scores of a segment; the first that fits counts.
RANGE_SEGMENTS = (('Champions', (4, 4, 4), (4, 4, 4)), ('Loyal Customers', (3, 4, 3), (4, 4, 4)),
 ('Potential Loyalists', (4, 3, 3), (4, 4, 4)), ('New Customers', (4, 1, 1), (4, 2, 2)),
 ('At Risk', (1, 4, 4), (2, 4, 4)), ('Need Attention', (1, 3, 2), (2, 4, 4)),
 ('Lost', (1, 1, 1), (2, 2, 2)))

SEGMENT_ADVICE = {'Champions': 'Thank them personally and show new lines first',
 'Loyal Customers': 'Give points for every order and suggest matching items',
 'Potential Loyalists': 'Write soon after a purchase and offer a membership',
 'New Customers': 'Explain the shop and give a reason for a second order',
 'At Risk': 'Ask what went wrong and offer something for a return',
 'Need Attention': 'Send reminders that fit what they bought before',
 'Lost': 'Try one strong offer, then stop writing',
 'Other': 'Keep watching until a pattern shows'}


def _emoji_class() -> str:
    """Characters with the Emoji property, but for digits and flag letters, as a class."""
    fits = regex.compile(r"(?![0-9#*]|\p{Regional_Indicator})\p{Emoji}")
    codes = [c for c in range(0x20, 0x20000) if not 0xD800 <= c < 0xE000 and fits.match(chr(c))]
    return "[" + "".join(f"\\x{{{c:X}}}" for c in codes) + "]"


EMOJI_CLASS = _emoji_class()
