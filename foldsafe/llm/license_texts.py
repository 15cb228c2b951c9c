"""Whole licence texts and headers as (licence, first canonical word, canonical words, SHA-256 of the canonical text).

A text has several rows where headings, list marks or line ends differ: a line that
starts with the word copyright is no part of a canonical text, so some ways to wrap
a text change it.
"""

TEXTS = (
    ("Apache-2.0", "apache", 1382, "36229a9956938571a99113d590fb0e618aa4a86f7ddbf0874bba96f83a26a8a5"),
    ("Apache-2.0", "apache", 1387, "e80c728dad9283541363fd9f60e4c0527fadc838f92f45f514c14da7f0a481ad"),
    ("Apache-2.0", "apache", 1395, "1d2490e65bade4b7cde700178105759a1eeb6ed401841c01b9ff35e40e55c5ad"),
    ("Apache-2.0", "apache", 1400, "e9dbf930ca0f1e090ec68da9a37b657d11bc9e43b30643455d6a96dbf73116ca"),
    ("Apache-2.0", "apache", 1558, "594673f8fe0542761280c31fa6f0d1eca9f491e533af6c2c1fef40b1c4229b47"),
    ("Apache-2.0", "apache", 1571, "ff7be961361eda3cd2a76927dd0d9482cf45defafde2045befedf77400d98100"),
    ("Apache-2.0", "licensed", 86, "7a46cf4a5d56898d746584f4fe57bdf571d600a8f39d21063431d88929f803c7"),
    ("Apache-2.0", "licensed", 86, "c40235f98e8998f2e4f5fc5131b16fb3c6c5f8ce252d3e6e08daf233725c2073"),
    ("BSD-2-Clause", "all", 162, "495c75a67a96ebc37cde1bb7e3bf893aa7489ba849d1371f73aa567066eba7b1"),
    ("BSD-2-Clause", "all", 163, "66620cb7b17d58762e14cd245150deb250497c2400947ca73a5259384989f247"),
    ("BSD-2-Clause", "all", 169, "834bb7ff9a78edec0c43053372cc3cc915e0bd62db28603318e9e91486ffa3d8"),
    ("BSD-2-Clause", "all", 169, "dc1275bfb226b807cfd6335e5fc2cf540481b4c0e50a7d8d9d7ac8b058023548"),
    ("BSD-2-Clause", "all", 170, "6b8cf338d34ea9e04053404e93983362dd67ebe00ed3ae1057d75e33c72b000f"),
    ("BSD-2-Clause", "all", 171, "24fec97a045adf3f654bbf8d2925d096207c632172bb4e6635deb0678704bb89"),
    ("BSD-2-Clause", "all", 171, "2c6bd6b96aceb50702b7b863d454d258d55497bef961d9a9ae9b8b804b87fab4"),
    ("BSD-2-Clause", "all", 171, "3d3b1bfcc6d83147ae629d3a6d87008df7c3ac55d9e5c7de9cf0eb169ad33a84"),
    ("BSD-2-Clause", "all", 171, "57a172b31798e30e8afdea698f266079f332f5959da73a3278d2407dc1c4fa7c"),
    ("BSD-2-Clause", "all", 171, "7ccf284bd8e799fa563a2f39038b1cb528487170ae5a09ed8bf3e5f410f2a97a"),
    ("BSD-2-Clause", "all", 171, "d427e2c3fd0754573797be430d7df721ae129b52e134c9dcffc1366f14cfcea2"),
    ("BSD-2-Clause", "all", 172, "d144ba470291fcbea192122ee87942726e8f3ce940fc2a2ef07eff68686d2ee8"),
    ("BSD-2-Clause", "all", 173, "0daf699c76af85574d0b15fa4aa367e9eef563ffa245766eefa89d533fa2d91e"),
    ("BSD-2-Clause", "all", 173, "1fe39939e31b062996d713af63c179c8c60f1f8ad97ba0a4868eea6800ebe993"),
    ("BSD-2-Clause", "all", 173, "80a6fa8d39d949408ee60b9b2cf720c6978e79d7771cc757a2a5cd7831df3fac"),
    ("BSD-2-Clause", "all", 175, "1f0ed2efe2254ff6b1475ff0f6c26914b8ac2b05be8ceb4ec69d7fac62adff7d"),
    ("BSD-2-Clause", "all", 177, "25dd2fcfbb2db79c8fe35837f895f8e11a24312b7579ebab226f3c6e3637a560"),
    ("BSD-2-Clause", "all", 177, "400c67a5224787355342361fe00103c116f0ccee903ff16fbf8f81ec669ef9c2"),
    ("BSD-2-Clause", "all", 178, "1127bada214e14268a36b27dd6ad53577e404eefc579c4d2e3c1fbff72ab6e6b"),
    ("BSD-2-Clause", "all", 178, "42406bd2032d0ef843d41c2b92d3dca8dd6a2331861200e8654b7a22f9f77924"),
    ("BSD-2-Clause", "all", 178, "5e3773d0812205162b4bbe7dbf238f8eb7cc98cdc3f34bd0764df6c76ac2977b"),
    ("BSD-2-Clause", "all", 179, "6c614af5bc88e1ff899c8942fc3099635fb16dafb37a951a0803b019fa82844a"),
    ("BSD-2-Clause", "all", 180, "58bdf186ce81cd3729c04ed5675a8963b9cd0ff20cde1ab890ec347fdc3ccdeb"),
    ("BSD-2-Clause", "all", 180, "635563309e7f03d2204403d6041f8a5cd1a55c1a1dae85a81df67a9597115933"),
    ("BSD-2-Clause", "all", 187, "957c3854a3d72e069e7f5e48857ad9ab76135f14c70d60fa9ec6ef9a928d45dd"),
    ("BSD-2-Clause", "all", 187, "9c47a682ef64c4e02c50c208384916c7f80087d4e4395b2b06e65a4c4b08b152"),
    ("BSD-2-Clause", "all", 189, "68f54bd97d77aa7c6d7a3706ff20555e202ff9393a9e5eaf4f0ebede2ff51a1f"),
    ("BSD-2-Clause", "all", 189, "eda2ad636e738f6a26a2fea902bb734ee48c789a5b40035b8db3659bd951e5bc"),
    ("BSD-2-Clause", "bsd", 163, "3adc887b03a4b313f08b9042652e9e5a1032a18c662b479927143e2452e572c8"),
    ("BSD-2-Clause", "bsd", 164, "ded5cf7c91017e1b58fd3b1adbcfc7c3879ee27ff1cfcb02eec3aec1df8b7a5e"),
    ("BSD-2-Clause", "bsd", 166, "d25da49f065ee99b012bc3069ac83c6df49c58683899972f88e61f0175c79b73"),
    ("BSD-2-Clause", "bsd", 167, "152df053ae636c8ba6ef842145f9d990aae26a3fb29e8da1278aecc4c11992ff"),
    ("BSD-2-Clause", "bsd", 170, "4987478bb92b6e85a414a80e733094a42e01c4416c8c0798dbebf6d8d4c1a255"),
    ("BSD-2-Clause", "bsd", 170, "8dac0394a6f484bce39926a431445a0b3a1189f62fde4d528cde48fbdf0e3867"),
    ("BSD-2-Clause", "bsd", 171, "42c64f58611cbe8c07c45a7f259c96df5a1e403368e54c19a765720aeeec959b"),
    ("BSD-2-Clause", "bsd", 172, "02ba455f3f46bdc8ecf0f812120e246703dd476fcd0bb6e768d4504e517c68e5"),
    ("BSD-2-Clause", "bsd", 172, "380488fd7e68c68b2727d76fb6a5f78ebcdd84b890d34b33deaec5520d2e487a"),
    ("BSD-2-Clause", "bsd", 172, "57e0cbe42c009b911925ea5edbd8324587e569fb9d93fc7860b25c25b26a6a53"),
    ("BSD-2-Clause", "bsd", 172, "5d818069ec731e9c3b1b77ba24f53b18eac4eee63b6cee9b447c021ac95ccf2b"),
    ("BSD-2-Clause", "bsd", 172, "737440156313382fc9d150f5fe2f7169fcd4e4b3b985c8ac722c8303771f7d85"),
    ("BSD-2-Clause", "bsd", 172, "b8ea8c13c504fc0885fc5e56248e599348b96aca7e149f9184d870a2cc4cd40a"),
    ("BSD-2-Clause", "bsd", 173, "6a0639b4ef31ee33b84bbe2cd784ad68ef3558ce5c08285bbafd459fa1e0fa34"),
    ("BSD-2-Clause", "bsd", 173, "b0163446c3049dcaf982cdef9887d5dd9efd271eedd20c5b462f28e638e1ee22"),
    ("BSD-2-Clause", "bsd", 173, "d184b5e3d78ddb4d077c5a3671bdb120ac86213b7af2d60e933e586c86a95b27"),
    ("BSD-2-Clause", "bsd", 174, "4b0224be8ab95933bacbafb86a9496373165c44566f7c8dd153861af92a153bb"),
    ("BSD-2-Clause", "bsd", 174, "8c4d325a445ce396c2e3fbcfb4b6b55746f07e9d0757372b47c8841dd761c7e8"),
    ("BSD-2-Clause", "bsd", 174, "a0be988917d26df54f327f77a9f3a624c6ab26d4f37ea0904bb5143ca7758554"),
    ("BSD-2-Clause", "bsd", 174, "b1419ee6326dbb88506f4aa0781bc778378016660a4e19bbf55ca1e3ab3ca612"),
    ("BSD-2-Clause", "bsd", 175, "2706e9b3775808debd0605442aa932bb7c1796cc264c5a6c26a920df0ced3b11"),
    ("BSD-2-Clause", "bsd", 175, "4cbdd4c03130cdee427c6e6065864995a14066dfe1381cfc0ead0de4567c2dfc"),
    ("BSD-2-Clause", "bsd", 175, "b8e47ce080cfa01977fe32e2754cc0f0f1fe482f7bd51f2e10b6860f5864c63d"),
    ("BSD-2-Clause", "bsd", 175, "cb9107748b848060717a78eb022452880c85198fce4173ba0fd3ba4a379ce63b"),
    ("BSD-2-Clause", "bsd", 175, "d29c5574460ff1817df029a8b11577a82b7da42009ad23bd69beb40b1468cb49"),
    ("BSD-2-Clause", "bsd", 175, "fc5ed711c23c415b4781cb4c22e318d308d1f574b9fc4338d6bc84a7950f8fd3"),
    ("BSD-2-Clause", "bsd", 176, "3706935d61ecd3d3a9d26a2a0438b26861d25023aa4a01645befd9887dcf978c"),
    ("BSD-2-Clause", "bsd", 176, "6a609591c79cc6521ad57679022e1bdd6477731e6a89588281afff18174230ad"),
    ("BSD-2-Clause", "bsd", 177, "3548782100fc635d09336fcdcab757774fab9a0747311426418e06cc6f4ca7d8"),
    ("BSD-2-Clause", "bsd", 177, "a902e483b29c262ee7e4bedd9aedc11d06cfe76a6a0456df6ebc6830985d29ac"),
    ("BSD-2-Clause", "bsd", 177, "f1055e15a2e7a51c7ebacb23a476509e7019856a81cafd884f61202844b45fc3"),
    ("BSD-2-Clause", "bsd", 178, "815cf339ff84a016846e25ed94ea028a2e124884c0049952e9dd96388bc91dd4"),
    ("BSD-2-Clause", "bsd", 178, "a3662323f889ddeb47b7480e468db50af3282aad57bb828f3a920b853244244b"),
    ("BSD-2-Clause", "bsd", 179, "091b7f555b14c4f29dd58deb693dee271efec9352ca241f5508360d1cb110762"),
    ("BSD-2-Clause", "bsd", 179, "7f320d5eca2e8d853020eea912fa3794c9b45da5365822f81fa40d90ccaa2efd"),
    ("BSD-2-Clause", "bsd", 179, "9dfe123024fd9daa6425975fb792aa7a91a2ba400852b26644b4309fd1c9c489"),
    ("BSD-2-Clause", "bsd", 179, "d19f5c423617b16640885e4f1deab7dce1392b24e32e3589efdd80ae65558fb8"),
    ("BSD-2-Clause", "bsd", 180, "a4b94ecd45e0eefa1288cfb97c181d83533f4b59f047f52905ed098793c7af7b"),
    ("BSD-2-Clause", "bsd", 181, "02ae0ae97a76028664256c46c7ea980bb1cf23bc4b73cbc9ff80111ea15a65f3"),
    ("BSD-2-Clause", "bsd", 181, "15d0a7d3bb4311215a9c84e8b3f7ba8abc962ec138ea315146ad75c7bd69e227"),
    ("BSD-2-Clause", "bsd", 181, "338ff14838bce0d3fb66c4cab051ba7ed2c482883648a536b4f5e056ac0a0619"),
    ("BSD-2-Clause", "bsd", 181, "b2c17352411726f6843e41644a29441d9bdaae69ff4557617f43bdde125bb1be"),
    ("BSD-2-Clause", "bsd", 182, "6436fc5f9650870c48851880613e1beeaf6062c9d0f961dc718d65ac96028993"),
    ("BSD-2-Clause", "bsd", 182, "adae9194fafe71ef6cb7c2c07828bbaaaca9d8ecf02f6a33a74e64553dce526b"),
    ("BSD-2-Clause", "bsd", 182, "fa520f0c6f816ddfe9e45eb360e4b10ab02f10ff6ad93d00e7d0cf6189efc5e7"),
    ("BSD-2-Clause", "bsd", 183, "7108f81b99348fe6f9cfd8a2d1678ab4dac0dac3efb87a57083c00f7b0bf4d15"),
    ("BSD-2-Clause", "bsd", 184, "2133407a91fb2f7432fde337a2f94c237fffb30c5ecf239e45fcd192ec20197c"),
    ("BSD-2-Clause", "bsd", 184, "764d36b3b3cfce500725994abf42ff81dd267ef6dc086c63fb5e2547051ecf0d"),
    ("BSD-2-Clause", "bsd", 188, "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2"),
    ("BSD-2-Clause", "bsd", 188, "6a5d49c15e02e9e94957d78177d86e8631be9a19549a7cfd2e8c3be2699f00b9"),
    ("BSD-2-Clause", "bsd", 190, "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2"),
    ("BSD-2-Clause", "bsd", 190, "85c46767b6234227cebe127f5c22b9ede02ee48dda5f148ccefe8432c4d93221"),
    ("BSD-2-Clause", "bsd", 191, "63151a500234e07ef3e50814b0d1d07db92c9481191003b577fbf42336ed40a0"),
    ("BSD-2-Clause", "bsd", 191, "a11471bc40750a21bd4508891b5626642657a09eaa0ef1ec576be7d37fe5ada8"),
    ("BSD-2-Clause", "bsd", 193, "ef3c818b28792f48774a4d16b461004c5e21338f9f74f2664f41f86803c30d60"),
    ("BSD-2-Clause", "bsd", 193, "f4befedc01589c90d5effeae5f64453726c8fded8e4b6fe6c36f99d303581f1f"),
    ("BSD-2-Clause", "redistribution", 159, "486c5a79f9c9e1d3c9fd02148242f01a0e06d3c87129e40ca1c6c973609cc929"),
    ("BSD-2-Clause", "redistribution", 160, "047f7f3b6d6f2d1ca18c906698805b140db8ed4f5e2d8e21c9e61d3ccbf5ee7d"),
    ("BSD-2-Clause", "redistribution", 166, "2a5ec32b1a1dbaea1abfc1e6634bd672adf53b76d75e91ef6a7f5b5ce9888a38"),
    ("BSD-2-Clause", "redistribution", 166, "aa6caadee42683703ad530c6e2ed6877849bcb16c8d2d34958831589f2b2f3e0"),
    ("BSD-2-Clause", "redistribution", 167, "2e26e021711b5d9631c88f8c0aafdb208594c8f804ab6bc051861d0ed78ad2ef"),
    ("BSD-2-Clause", "redistribution", 168, "1c0f29f577dd0a264bfcb782f525a4337ed6e7b082da7ce7e204d9d1bdf3a5fc"),
    ("BSD-2-Clause", "redistribution", 168, "6aa31f447e64b02386f400a5ae760c12249b1d2d46c5cb5a5823cbd6d42b3cbc"),
    ("BSD-2-Clause", "redistribution", 168, "d79c88c2992d7bd5657aaf16ec0313aada67de1ccf916755110eee6253aeb17b"),
    ("BSD-2-Clause", "redistribution", 168, "e37e3fc9f1f585052e6d1c5d92cc34caaafc76281396cb112ed48bf015df8ec2"),
    ("BSD-2-Clause", "redistribution", 168, "e6aa59660db36f4d70d04887b38e3eb781b2331bd6abe9d2521b2e31c03a33c1"),
    ("BSD-2-Clause", "redistribution", 168, "f1062ae1414f9caafc370bde8f96249b456f447509359f0cd959d99de31b8300"),
    ("BSD-2-Clause", "redistribution", 169, "6a87f9aa76e24e5e3c53520d84bd7a7696f71745fa526f7f08857d89f7c9ede9"),
    ("BSD-2-Clause", "redistribution", 170, "2cdbd19e6cce863a8c4d3f9d772e9031a973b4c15532f1d54d1f5e8dcbabcdf3"),
    ("BSD-2-Clause", "redistribution", 170, "529a212c262afe066889ef08ef0122e1dbf74c59a5279f9098edbcb7e79152f5"),
    ("BSD-2-Clause", "redistribution", 170, "d05b764a85100d2cabe8035a2ee483a58e3d4da8595345609bbda6e1295ec8ec"),
    ("BSD-2-Clause", "redistribution", 172, "ff422dec13bf86fa71167ad5d8df05bf613d41cfdd8777b6717794b85ca0fdb3"),
    ("BSD-2-Clause", "redistribution", 174, "3ff743c3aedb9858eec3d4cc7581f9c7ae9acc51c27ace3e4e52a321358729bd"),
    ("BSD-2-Clause", "redistribution", 174, "f2d1e1e0a375553c64bc8ae7ff2280be75707044af28710ecec469fd1430b7f2"),
    ("BSD-2-Clause", "redistribution", 175, "7ea5ea5c1901236f217af42ce12a3491c74efef8c60b374d3a8065db5b54b7e5"),
    ("BSD-2-Clause", "redistribution", 175, "aba277afc643dbf1494368bf6762217a15117b2e5ce234f1971e64a05cd252f8"),
    ("BSD-2-Clause", "redistribution", 175, "bf4f7cfed9298c09d396078993d3bdeadded0c0c189b5f157436a5eb6a53af38"),
    ("BSD-2-Clause", "redistribution", 176, "302281c371585c8eb34cabb723fb40185a3efeb5bbb0c46f7e1728918ab5380e"),
    ("BSD-2-Clause", "redistribution", 177, "06f8ee44eb71c61888169d785a096adc17e49e8f7d9ab472126b65f462cab7b5"),
    ("BSD-2-Clause", "redistribution", 177, "349168cc5c9f16306ca3cdbf3442914dcedb3b7a169a9d26e3859408c4197859"),
    ("BSD-2-Clause", "redistribution", 184, "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2"),
    ("BSD-2-Clause", "redistribution", 184, "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "redistribution", 186, "5151319f99abfc15f9a1aab05c799faf3b0e5715fac5a5812b9d3566ae984374"),
    ("BSD-2-Clause", "redistribution", 186, "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-2-Clause", "the", 164, "efaf14e8ae43a9d76e97043b10910c93d0b5caaf220913c14c12f349fb817fb2"),
    ("BSD-2-Clause", "the", 165, "43822845fe776750b248eaf81e4f553bf3186f25995be83e84a27e2bc2f79e47"),
    ("BSD-2-Clause", "the", 171, "509f666858f5159edd9cb773b09bf6b481ae791faeb7d7789ad359e5ffc80752"),
    ("BSD-2-Clause", "the", 171, "fba0c63606fc3748d94b0734e3a234e159b649e571554696f02e46aba2d7596b"),
    ("BSD-2-Clause", "the", 172, "e4baef52fde379abb0acd793f811c80e9125e6338e1e75819481eaed28b0f4a0"),
    ("BSD-2-Clause", "the", 173, "0bf14fbef913b055a754cb60511fc8de984f8aaa3d08315a8abf9463385534bd"),
    ("BSD-2-Clause", "the", 173, "4e02839e6283b547f270d28317ed0cd0a4bc81713778be2327055ad95dd2a274"),
    ("BSD-2-Clause", "the", 173, "846841864df57168733893a7faa3cc417c278dee48fa8478d1845c903f0cdca5"),
    ("BSD-2-Clause", "the", 173, "89f74def23361fecb34e312214b24c14cc39f0431347493485e683ad4ca6c134"),
    ("BSD-2-Clause", "the", 173, "cd17ca05a9fd280cca4a1b5ad83ed46324f31da615f613bfeeac565f1362d4b1"),
    ("BSD-2-Clause", "the", 173, "f8e058ab5f69a7b216225f78aeea70cb4e472d549fb308429ea414789909cdf7"),
    ("BSD-2-Clause", "the", 174, "6489df8f3bfbf96af1b8b3f85b7278336b86b01d24a5af50b7ef5ad1c7c451bc"),
    ("BSD-2-Clause", "the", 175, "142db4ff97fc8fde6968104acea75da31dd21028af10d0af1c4939bd90fd6c26"),
    ("BSD-2-Clause", "the", 175, "34eed97d11c363a98cb6e2ddd5aebf6b25b44fabe292e3627d88af96ef506b5c"),
    ("BSD-2-Clause", "the", 175, "f4ec44b04caa59ac99454454ada7126774370ed8f94b2b3cd4c646751deb5ec4"),
    ("BSD-2-Clause", "the", 177, "468d578876d510bf793ec74334f01a242bc315542daf954cca31dca4f50aa37d"),
    ("BSD-2-Clause", "the", 179, "4c3fc9f21890ed2d0da044d07847a55f1c155df0673e7efb7886a28f9c46f25f"),
    ("BSD-2-Clause", "the", 179, "67edf633eed2193671ce24d8e644d54a81b98a54ea7fbccda237ddb60294de7b"),
    ("BSD-2-Clause", "the", 180, "39fe576e9854674e76af2000fec05fb36ff68bdfacab295d229a4f29c9f75be5"),
    ("BSD-2-Clause", "the", 180, "564b161c057027eba2949bbc2e717f2ed5c66dfb4ea7319e692c553c93521a6f"),
    ("BSD-2-Clause", "the", 180, "e1c9ee22a78b1ae2d95519f1959556f9ca0809f223339573ed7258b89f3d03cf"),
    ("BSD-2-Clause", "the", 181, "ababa3c4e7300b4bec117c0937b99a6251bb34cadcbd0178eec9122cc5db4241"),
    ("BSD-2-Clause", "the", 182, "37506a22130c10c4a82ca9bd3fe7b591ba2803179450b36e74c88b153eba3640"),
    ("BSD-2-Clause", "the", 182, "7419f017766c07c16c569e2b22029a50097580529a62fec1de2be2f76d6ba618"),
    ("BSD-2-Clause", "the", 189, "117fa84a7ffb2cb3a2ba7d18dd284e7283b034d6fb6c6419721ee4e28b5306fe"),
    ("BSD-2-Clause", "the", 189, "e90608a663ae638023eb95a6ae359f7b6b865e6237fa832c48500c4e1af035b9"),
    ("BSD-2-Clause", "the", 191, "239190ee903aca2851ccd5099cd7954d026d60f9b9f98e391ca652499c6aaae1"),
    ("BSD-2-Clause", "the", 191, "f9c0de945db946a0b06e8587a80b1b35b3f3e48a0f63cb64860eb4e433d32c7b"),
    ("BSD-3-Clause", "all", 192, "95aa9d8ecdf1d6d8577e48d482d1b37af7e9c534c51b0421e5d86c5c0a632a5b"),
    ("BSD-3-Clause", "all", 193, "e0221e82a92d5013bcf95f4e08bf5b1a52bf16ce283e8e41e3e6440f311740bf"),
    ("BSD-3-Clause", "all", 199, "197dfca79e412fc0a520f296b8c065090824f500db565488d3bb737e78e444ea"),
    ("BSD-3-Clause", "all", 199, "8bd7094b27edcf5dffd338d8a1d8d93ea997eba41282c3c46c1c3bb63397d7e6"),
    ("BSD-3-Clause", "all", 201, "313ba051924fc7e9ad0799e0697f1c421ea897fcbc1083a5598230491ed364e4"),
    ("BSD-3-Clause", "all", 201, "36a34abe5650cbc187b161d17fae93481d88685006423ad722c406ccb745d60e"),
    ("BSD-3-Clause", "all", 201, "e39aafb5bcab057d40e191951d73b35db0cdd852651981000bea795aac754b11"),
    ("BSD-3-Clause", "all", 201, "fdb592794f85ad30b8eb7c4fed59bb2c80b50f93990776599ddd6422328dfcca"),
    ("BSD-3-Clause", "all", 202, "58c6cc53203552dc46606536313adde0500d6793a6882ce9324e342e1d11a29b"),
    ("BSD-3-Clause", "all", 202, "95f5acc969b6d63540458f8e37cf5b16d09cbfc5906866b86270e90a849ce936"),
    ("BSD-3-Clause", "all", 202, "ef551918c3393a317d8119b7a6b5e755156ab1cf56536e9c0b59745b29b7c3d8"),
    ("BSD-3-Clause", "all", 203, "d37cba8a8a0f811f205ee246ed3b9a58523a53ee4508ecbfc8692b53ef691a9d"),
    ("BSD-3-Clause", "all", 204, "4899268c07b167a1358793955ef5ddd00c0bc938ea8ab10ff9290f1f43bae701"),
    ("BSD-3-Clause", "all", 204, "7a1a627d2064907d3daf3c753685f56c08244b0b9183556902e22aa7c8f4609c"),
    ("BSD-3-Clause", "all", 204, "99d85b82b49b7852c8b204d96ae99a740748f80fe087debd81d50095e795f4df"),
    ("BSD-3-Clause", "all", 205, "6a4185525cf43cb03772c36a5fa7e45ed73f0b0a1069608ed3dea18c5a1f1ecb"),
    ("BSD-3-Clause", "all", 207, "62602d662c4c3d993355b2b270f69ea47596bcbc4baa03c0b7d226b5318c7357"),
    ("BSD-3-Clause", "all", 208, "0c5f7a390ddb4d22e3c894df5aa56200b63843879296caaa04a1dacbf4e498db"),
    ("BSD-3-Clause", "all", 208, "6ba4e34939c8093f8ac4ba6f84e885e68fa6e27431ef137c3244262e0e7a018d"),
    ("BSD-3-Clause", "all", 208, "76b8b5ed1e7cdd853f381df742e295ae96dbc4f834e95342966ec7fa7eba8f7d"),
    ("BSD-3-Clause", "all", 208, "be10818ff4c666d0d8e33f42ad06f55f865023a5b074b9ce85833bf1a6244d70"),
    ("BSD-3-Clause", "all", 210, "6bdeb43c588383f00506e470c7ab1064d4ee4c0716dd9d7e26633586d88da414"),
    ("BSD-3-Clause", "all", 211, "09be957cc6899aeb649c2d6262edc3a0d4393f2d996f1be822884d75718e8fb2"),
    ("BSD-3-Clause", "all", 211, "c80565f89e0eaddf05998c7154ca80cecc4e7af4d487f41f1714b271c43d456d"),
    ("BSD-3-Clause", "all", 217, "007fde9b266f35183b511c8c01994581175bfdaa48438967e905c31fb50ba523"),
    ("BSD-3-Clause", "all", 217, "6fc618780b44cdca4b29e5e2df831e67dfee9bade4a4996c59b815c2bfdb566c"),
    ("BSD-3-Clause", "all", 220, "e327b35e2b01d84b108447cf1bd62958a3a0431b96631ab4f225c0b10e274f1f"),
    ("BSD-3-Clause", "all", 220, "eabe215ff5a2cf5b1c090915b7cabdf511f70fc79fb8fde85247ebe3038a9658"),
    ("BSD-3-Clause", "bsd", 193, "4d4e4cc35e297f61b4b915d94c006499c4220465962eb3c687e18f95fc780c09"),
    ("BSD-3-Clause", "bsd", 194, "aae08a1a56472c60d58d93554f8fac210e745ed1dfdd7f73c129508dd68608b6"),
    ("BSD-3-Clause", "bsd", 196, "a2568c7c93a0f27957d5d77ca20c97f40aebaac97ac637bd0719addf53cad41f"),
    ("BSD-3-Clause", "bsd", 197, "7d00890a6ad2a959ef374fc0836ebcb7d3da7d8fc6aa8b23f1340f9b9512dca5"),
    ("BSD-3-Clause", "bsd", 200, "b5c263aec10658dd41db3363140e32874e2ff17d4c258907b85d517a31629ec8"),
    ("BSD-3-Clause", "bsd", 200, "b62cae29262c36fa4ef6dbb6cfafe5ac6e6d960fb8e0924e2820f7f4a5f3c51d"),
    ("BSD-3-Clause", "bsd", 202, "4a1ab8837372cea90cb2a723ef42180f32b303dc981fdcf5ad3c8f5b47c30f6f"),
    ("BSD-3-Clause", "bsd", 202, "55cc4c41e24c916cd9b0b01ab52ac5289f68a893eee7b98c433d08aec1cfacdf"),
    ("BSD-3-Clause", "bsd", 202, "6e1f213e21761d100dfc4f166dc90afb44688dc7f3ba35ef32143b4ca452d102"),
    ("BSD-3-Clause", "bsd", 202, "f05eaa381daf40de143ac143ae89df5cae9ded80c0ecdd580ad0d5a39b5de832"),
    ("BSD-3-Clause", "bsd", 203, "1ae610c6223ee0376e7e06b67e132f2296306bed988a1d54beff2d88fa8c6571"),
    ("BSD-3-Clause", "bsd", 203, "69cb385f6fb18295ebb9b79e5539e885c810dfc437e52547f1695bb091d75171"),
    ("BSD-3-Clause", "bsd", 203, "98d7a070b8c4911ff1543a65cafbc39353c5b0b5d533640a9d6932fb19ba5239"),
    ("BSD-3-Clause", "bsd", 203, "d64255c14e9b8d646d5b4c525cc3fc37d1d32d1d11836fc2b741497cf9219647"),
    ("BSD-3-Clause", "bsd", 203, "ddf7d19bd97224a5ebe6ed2034d44d9c12d4d31e184cff81557a0f778e529555"),
    ("BSD-3-Clause", "bsd", 204, "ac3b6055ee400589c3df9408e6e259a34f6008d32712e60ef28f8b6c883746b9"),
    ("BSD-3-Clause", "bsd", 205, "209efd9dbf9a70b6bc8379810ac1715bc530e7547f7ca5c7796d5a8734bfb861"),
    ("BSD-3-Clause", "bsd", 205, "29254194d570da3df6afc0b3c009c32b3bf294c6784ee3472d6d2a9912cf0f08"),
    ("BSD-3-Clause", "bsd", 205, "296105974c851ed8a9f01405d608379cda09ab106d25df28108090eab0b9ef17"),
    ("BSD-3-Clause", "bsd", 205, "9b8cd3d22ee9082a66f2d411e37585517cb490d66cfec1efa99f34bc303e3b0d"),
    ("BSD-3-Clause", "bsd", 205, "9d929e17601d2ff1fc42ad4739093664f0431e24bbafe7aba12b90af41efaed6"),
    ("BSD-3-Clause", "bsd", 205, "9e4c5667e941fc6e3efc969135c958becdaf93c5131f513a3b3625467da01de0"),
    ("BSD-3-Clause", "bsd", 205, "f6ff1fa4722b7849b8c8b83f1e982953fd93af1ae96673494b50b668f45b3dae"),
    ("BSD-3-Clause", "bsd", 206, "2a69334be2c9d34c52abdeef716a66403fa3a818a4cc95b6dec6f7c395661756"),
    ("BSD-3-Clause", "bsd", 206, "5bff7539b14e43112d37644b9d582eccc50046abcf56025d221344b32eadb241"),
    ("BSD-3-Clause", "bsd", 206, "608c3678c1b5959509cbc1d7a187d1e63874a66519a6e9670384d598b749add3"),
    ("BSD-3-Clause", "bsd", 206, "ff3863f7d6f46261169bb1cf6ee91815c6371972422776756517ec26147ec784"),
    ("BSD-3-Clause", "bsd", 207, "5096d926dd1224a4ab19ac9fbe7887db457c5bf2b0254806f675c9baa5011fee"),
    ("BSD-3-Clause", "bsd", 208, "1d9879b4ef8dc3bfc8a78a14d1d7d81957b7c4db328bf0c2364779ee46dddae3"),
    ("BSD-3-Clause", "bsd", 208, "4331a855da15fba6cf668eddb8071af9122d2ec86f07b85c49ee1ff9007b581d"),
    ("BSD-3-Clause", "bsd", 208, "6f4ce5fd799cd6c1bf533f90976156bff0afff221716b0a98c1a0fec5ad96667"),
    ("BSD-3-Clause", "bsd", 208, "70e08f6e3dea9fdf506b70d13c831a8202bd3dd29561fe298f71f6622a1442d9"),
    ("BSD-3-Clause", "bsd", 209, "1dd2167d33e6abb12bd24f83a8aa47152fb67b33c41d0d13b5fb882f9207e603"),
    ("BSD-3-Clause", "bsd", 209, "31f35a6161da8451a3f5efb84d9c6c28e247535cd9c50692759198f25233af9c"),
    ("BSD-3-Clause", "bsd", 209, "4d7a33765f48606ec79e77b86df7cdcbc4df9e4b25a17ad7656a8e795f8a1c66"),
    ("BSD-3-Clause", "bsd", 209, "a44b3bea5c840a5b1249736e2644261e528c70d7f37eda741daa2d3979a26edd"),
    ("BSD-3-Clause", "bsd", 209, "e28a7a345b6cae92147912ac852691d2c9d4e58e836e218f08725662e860a1ff"),
    ("BSD-3-Clause", "bsd", 211, "8e8330796db4a8b8177030bbafafe5462c89b6cf184a17abf3a5fbf37c6201c6"),
    ("BSD-3-Clause", "bsd", 211, "c389363b751c4c81328f115b3f8d85cede6acf435519f2030b61fc21ba20704d"),
    ("BSD-3-Clause", "bsd", 212, "033c3332bee7ad5b2d518ac8935cfb24e360461627e7d8a5841215f87568de7d"),
    ("BSD-3-Clause", "bsd", 212, "1f56e03a0af29f4a51488b3049370426b11c8b8d2dd3bde0f7ff17a956d7a971"),
    ("BSD-3-Clause", "bsd", 212, "768ac3a51feee93f4f7472189e096d88c2c02f0e459d2baea1870668a91e7f2b"),
    ("BSD-3-Clause", "bsd", 212, "d87af98b46b8a6eddcd45f438ea142c83f1cb05e69391081d1e6dd7b7f572629"),
    ("BSD-3-Clause", "bsd", 212, "de1f189e38dcdbda76ad5509b1e3af9031f0f26e0fb8d06b241a30f7e3d8764b"),
    ("BSD-3-Clause", "bsd", 212, "de87151bd1c2129fc05c50f7fe5767f7505526200c106aba9dad75567276b246"),
    ("BSD-3-Clause", "bsd", 214, "55d494ad3cad4db13560d8b59a198430ec8019a4538330406209d38c91450feb"),
    ("BSD-3-Clause", "bsd", 215, "479345494aa085a4a09faf48ab7b38a9f193f1b39f601ffc16ff459c741c8b6f"),
    ("BSD-3-Clause", "bsd", 215, "4f5363f42539da1a8a2ac5e5c1511d0f3188135dea796e26ff15e3d390148546"),
    ("BSD-3-Clause", "bsd", 218, "0fbd7c43c4bb3e398d262b8e39f58ee0a8709a2b3b6b4bee4e033b3d5755f58d"),
    ("BSD-3-Clause", "bsd", 218, "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af"),
    ("BSD-3-Clause", "bsd", 221, "1238550805feaeec7ac6f60c2a1b7b3828c3fb1e9d9d52c718c3b75c7b5ff98e"),
    ("BSD-3-Clause", "bsd", 221, "94a0a44b170114affb7b3975c6987906dca819b6cbd93510aa70be57345a1e3f"),
    ("BSD-3-Clause", "bsd", 221, "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15"),
    ("BSD-3-Clause", "bsd", 221, "f2f49b468edc6b1259a03d37c9635c3525e11ce7388ab69d63d77cf3755741f2"),
    ("BSD-3-Clause", "bsd", 224, "4bfb244e03bb8ff80f6efb1a78cded6cfd77aefc484bcea2baaf4096ac8e1f60"),
    ("BSD-3-Clause", "bsd", 224, "cf77ee3d20f4076cecdb58fc53aa7204c9f5c0651621abbc85e028f5b2ffa6b4"),
    ("BSD-3-Clause", "redistribution", 189, "1249477861e89f1bd043cbb1b6cc7a7884c27e8bccfd495fe072e417421f4e22"),
    ("BSD-3-Clause", "redistribution", 190, "348fc5c18ce0607a313b28b17a24347c69ef0e86bbbc1cfdf63dd82357cf76c5"),
    ("BSD-3-Clause", "redistribution", 196, "3f739658d099c8939eea7c28198f60965d1136233da12d606b1254180a638524"),
    ("BSD-3-Clause", "redistribution", 196, "3ff0aab0c8eda8455de83fe07680908a0ed41d3818a8c4bcdbe3c173dc16960d"),
    ("BSD-3-Clause", "redistribution", 198, "47febcbcb6fd7914a4a37e79bea027d29f87cf44332f8368f67e02528e96a187"),
    ("BSD-3-Clause", "redistribution", 198, "4fb496f642ea94cc1359198689d079a5d4631caab15bc2f3f1e3e976eddf4c16"),
    ("BSD-3-Clause", "redistribution", 198, "5905a81a9300ef5ecebed9f7c30364995f740cb67c1f9a4b07ed4d708c1b1992"),
    ("BSD-3-Clause", "redistribution", 198, "6d4504d52dbe0a205902e304260e8257d956886bf22eb4de38a5566e3a771e45"),
    ("BSD-3-Clause", "redistribution", 199, "a49c6a53d0c35bb8d958544a7b143839f37db7aca0eb14899d0205bc311bed3e"),
    ("BSD-3-Clause", "redistribution", 199, "a9fb4347cd2ffd75fcd0b1ab478c8dd05f57c4218b39ae3e05f0d01e28c7cff2"),
    ("BSD-3-Clause", "redistribution", 199, "f15b5367a5b21500ad61ac988d561f114dfba954728747ca5557f30477109012"),
    ("BSD-3-Clause", "redistribution", 200, "66a189ad6d10fbb59dde11c7d5c9678db30687bd43ec350dd5e48c049347b53e"),
    ("BSD-3-Clause", "redistribution", 201, "8979c01134a5b771fada7b6c8fbbd2d554f55225b4d19641a2d76fca980d5591"),
    ("BSD-3-Clause", "redistribution", 201, "9e838bb2fae605584860e7f7a5a5e0be4db70b116f235e1d8825936efe476329"),
    ("BSD-3-Clause", "redistribution", 201, "c64ce17f4341cce03584e1e95429301adc46fadb93ffad62636a7864f77d410b"),
    ("BSD-3-Clause", "redistribution", 202, "2ff8b8deb86902e1bbffccd67d7c8b883d38977cf5f2d3db242b40daaa725a1e"),
    ("BSD-3-Clause", "redistribution", 204, "bb0befeee493b45dc787f07382dd616220abf25110c0155628a9f03e9919185c"),
    ("BSD-3-Clause", "redistribution", 205, "0b82da0b12bf7e635712c8df6f106ca03150b98897dd91d8ded1e19f7e1eb17b"),
    ("BSD-3-Clause", "redistribution", 205, "3f2310aca6fa04bc54180dde72c8ec0f0df865ee0abfd9e583a8c864a91ff261"),
    ("BSD-3-Clause", "redistribution", 205, "8566c10c4554dd5bad2d35aa10afbe86690fa7cf211fc6a77fe449f6045a357c"),
    ("BSD-3-Clause", "redistribution", 205, "a0c6d226e9ff5a08ca18ef0d8cea0b4d46c8f8ff638945669c950b97d778f26f"),
    ("BSD-3-Clause", "redistribution", 207, "be5d963bbb7d40f40e2c150ee03cea1312972c0b9fec02daf94ff70efae00a54"),
    ("BSD-3-Clause", "redistribution", 208, "0dbee7da51f4825baab1f275ab44138b7ffa736c74370f94a0796b88edb2bb39"),
    ("BSD-3-Clause", "redistribution", 208, "c32ae679d66221f3ac819c26b2bd1bf237324a7fc11f4579076053660ea15a2d"),
    ("BSD-3-Clause", "redistribution", 214, "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", "redistribution", 214, "b6ab7953b6c80a72261014244324a70663f1807fa212f52461b24c95eb16b4a9"),
    ("BSD-3-Clause", "redistribution", 217, "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", "redistribution", 217, "cc3432eb2f19bb6fe96706bad75b6fce1039db64fb70486899bf6425dea4d9cb"),
    ("BSD-3-Clause", "the", 194, "907eb854f396f4eea57a28f2a3eecdc5030547a710f38704a673ac0c98ef1c0c"),
    ("BSD-3-Clause", "the", 195, "c48b2aa966a8a939722382966eded1dd8bc61b76d9ae69ff06ae1b120d1aa006"),
    ("BSD-3-Clause", "the", 201, "1a79b81edf7b585e9f615fabd0c84b6c42cce59bff56a696adf14884a45b1327"),
    ("BSD-3-Clause", "the", 201, "e1723d2dbf64cd117cd972ad821695d54492ecd865191e5fca1614eb36de26fd"),
    ("BSD-3-Clause", "the", 203, "3f4c37391f7e427049dd3169b08b0c9da24d79a9f88b50d8950b8873ab8895c4"),
    ("BSD-3-Clause", "the", 203, "7c640d7abb1ac1ff5d47a89eb13585031136362e4dbb13bf8c046ca008836c66"),
    ("BSD-3-Clause", "the", 203, "d11fa99c441cd2d9da283a6cb431387ef20d589551000ab43d9d7dba119f348a"),
    ("BSD-3-Clause", "the", 203, "e3073db154a505214f7a3a7f8eaceb3e895c241caa4c87770fef1d49d45e96b0"),
    ("BSD-3-Clause", "the", 204, "66bc67212d6f390fd503d0c1ecc1975cd9f55adc62a796301ed761177d3a5230"),
    ("BSD-3-Clause", "the", 204, "a6876dc25cea40d5a795590505e409357874eb6cfdabde943d5e8f2f2433bdba"),
    ("BSD-3-Clause", "the", 204, "ed8f5bdb659af7e5763c73d480d1c0c87b2709b15f6fc6152e8331af634cd9ab"),
    ("BSD-3-Clause", "the", 205, "82cceb54c0862a191bef29651ec3726c16b41394fe1a855f89516abf564a9db9"),
    ("BSD-3-Clause", "the", 206, "86d44c8a21a7621d1478e40c5920b4e04bda8cf1708008179403cc0da60ea67b"),
    ("BSD-3-Clause", "the", 206, "af783609c0b29399f6f98fd91d1c961832fb36ee5e052304a3f84312bab4577c"),
    ("BSD-3-Clause", "the", 206, "e2a1217c1684ea23b9f0930e96eccd3b4e2231ecb446add4fe13952069903b6e"),
    ("BSD-3-Clause", "the", 207, "4ecf9617bca3289347696b4358989cfdcfa9cec3dafccb27805d47d8ba1b8dc9"),
    ("BSD-3-Clause", "the", 209, "8ba9e647f0eeda1538ba42d151353f00e93778d0e8bf7db8fc0ca95c4d4099da"),
    ("BSD-3-Clause", "the", 210, "7fb43a0e158c4791eafa62ff3a955e72d457c2c71c7f47537cb8ff777ac50217"),
    ("BSD-3-Clause", "the", 210, "899b5070cf88adf6e0ae9b798e6d64d21c73f7cfb767fdd7736b65725f71bfd2"),
    ("BSD-3-Clause", "the", 210, "f3fef62bf737ffbcc934bf34c83ea11949c7a6e3dcca3c3abced339e57ef89d6"),
    ("BSD-3-Clause", "the", 210, "fff965acaee81851e2df713924bc1c7b5f61a6611cb9f6ffbd9f45fb0d5330c6"),
    ("BSD-3-Clause", "the", 212, "35b1040aa56d198d48f31cfdfd8ab0b2b72d3362e9d48b398fc2b46a5f1578a9"),
    ("BSD-3-Clause", "the", 213, "7d7b0ab27bd68c8e9179920326a33abd47556117335a07c693a4ca3d35c6a029"),
    ("BSD-3-Clause", "the", 213, "ea846a05ee9170bbf0b797573d9595cfc11d8eb25d4b255ce8009a42db3c643a"),
    ("BSD-3-Clause", "the", 219, "2197427e156dd704210ae726a3807f7deae35bc31d7243168c575348f6a5419b"),
    ("BSD-3-Clause", "the", 219, "326c317935b3409d9750fd4ad5326ce15c9b75d313b4baf2cb9ff54accf8d903"),
    ("BSD-3-Clause", "the", 222, "52c8e1f1387429e4ac2e46a159e2b2d17320de20b05dce03cbd7a7cf9be73702"),
    ("BSD-3-Clause", "the", 222, "73a15ef51d0f74bce7fc4d1287b8d8a639c37581de7f63863957aea115dca7da"),
    ("CC0-1.0", "creative", 1088, "0c3e4ca5ed7ced6289d3f5d9a83e4100f9f34d87983b17dc5865376a8a0a98f3"),
    ("GPL-2.0", "gnu", 2470, "c928252f428993b646c70c671425ec87aab1bc5abf42e7a179685a96469bd918"),
    ("GPL-2.0", "gnu", 2475, "19329ee16e4a9fb2e74ce40708e49f5c315b4f0ac4653c556ca42027ba79f9f5"),
    ("GPL-2.0", "gnu", 2489, "a1e7ba14d8d85807f384435b77f91e925decc43da128311c991c4f2337e44017"),
    ("GPL-2.0", "gnu", 2494, "e4d14510e41435c3eb12c255b72546a3cb9943f06f209c72bc30a19095b08999"),
    ("GPL-2.0", "gnu", 2952, "b7f81dc9aaaa645304fde476859dc46db4e23b83ec1c50bd8462652ff46110c9"),
    ("GPL-2.0", "gnu", 2965, "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"),
    ("GPL-3.0", "gnu", 5214, "3d4de016a08e1d98b27dec755cdf4530b92807d97aaa185b32e12d52942b1943"),
    ("GPL-3.0", "gnu", 5217, "3129d737330c12f3281f0f8fcd4799ddbc6f254181868ae29d6ca65827f0682b"),
    ("GPL-3.0", "gnu", 5219, "3dcf77ad8c25248618918aaff1de8a2cb80cea6ca922ef4a7a389cca96a7560b"),
    ("GPL-3.0", "gnu", 5222, "7300741b7882c4cee1198306545302285397b5dbcfa263d41588b8b85e01aefd"),
    ("GPL-3.0", "gnu", 5662, "f3ab5ee40da170411ea6671f9845ada2aaba303ee57ba6086b373d1e66c9dc3f"),
    ("GPL-3.0", "gnu", 5671, "39a6efa3076af232de61a13d09b777c9757af7b24bc258ead3c3e02130c0c999"),
    ("ISC", "isc", 101, "7ece164e32bcb780154bd1351f36e38edf6dcbf957322ae0e23a59495a2808ab"),
    ("ISC", "isc", 102, "7db7feaca601a3f47ece3ea55df918fdd5fafee8df37de84f893d66f297ffe58"),
    ("ISC", "isc", 103, "acc16c310f36205de97961f718b87cf33e8987c1d4e716735982d00452853114"),
    ("ISC", "isc", 104, "94b4e9f723d13830ec6a47b422738caee264943af1673fa32782cefd730ffc82"),
    ("ISC", "isc", 111, "68cd3b9a1779ba2e8eab1875d0cbaf9b66d4b5bb00a2d65f98d027ce9d50d2ba"),
    ("ISC", "isc", 112, "3d522e40b21fe47f1c0b4ba98d2813c76a08e24b8869559e32371e837ae9fa78"),
    ("ISC", "isc", 113, "673f59dc8ad54524704b5b5d2deeb39eec917afad46597b1b7d4f2963edff317"),
    ("ISC", "isc", 114, "f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee"),
    ("ISC", "permission", 99, "271138af7f890e1dfc59ea36b53a520e68466fef04718457e84dc0932f19cb41"),
    ("ISC", "permission", 100, "1521e050b9546a1b1f81fd891936e216befd12188bdec168e56cffa4e2b363fe"),
    ("ISC", "permission", 101, "100382f94d83ebf7c27d387efa8de2343d2263e9e3fa39753947e9653a10a70d"),
    ("ISC", "permission", 102, "6e9dc1cd727a12354f4cef293d9d285ed81ed312d597842774d1120ac62a6dc6"),
    ("ISC", "permission", 109, "c8dc4820b7294d311a05f9458126f473d2e604645536d64bac2b3e70f83c6d3a"),
    ("ISC", "permission", 110, "7bed11ada181e6a63598e2da423080dd990b5647feaf0f67008662a131aec2c7"),
    ("ISC", "permission", 111, "280d76b420aeff51730e96577a2466120c91213f03dd50d60107078c498c5b29"),
    ("ISC", "permission", 112, "217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a"),
    ("ISC", "the", 102, "63696aae5d274dd19e37b61d112be93839e1c08ff4c46d232e83b8d6ff74b7af"),
    ("ISC", "the", 103, "aff0319033d77b6161af7caf219b84022495782ccbcb124326fc4885c2cba9ef"),
    ("ISC", "the", 104, "769bd8d7292704236f3ed32111292367b7b0a1301a136cc61c0f551e7060ba09"),
    ("ISC", "the", 105, "e00f31f158e77a60e7375307e014eeb17754967f6d6757d019567221315db4e1"),
    ("ISC", "the", 112, "b8bccf071a9e4caa2fa23a130c6e25fe4ed53dd1750c125e06a7712517f3a50e"),
    ("ISC", "the", 113, "dd20ca7f0f128eaf02cf7ecc69098fffb747ba179eba3e3735a73e67febfa360"),
    ("ISC", "the", 114, "8ee0d4f927294d5cfe44a2a4b1faecb347cc94d0e53edd910b1abc0f6527865f"),
    ("ISC", "the", 115, "40e6eb51c3b409d93549806b55b249c261dab149d19b56cc163624f39a08b1db"),
    ("LGPL-2.1", "gnu", 4366, "cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345"),
    ("LGPL-2.1", "gnu", 4378, "6d05f602d7a9f9950f9537100bd504a7fdab92cfe89f4f94b0d15721ee014b1f"),
    ("LGPL-3.0", "gnu", 1212, "11a7eabf884f5575b70a6cff6628e05126a0a629a3b4fb202a995d21f65452b8"),
    ("LGPL-3.0", "gnu", 1231, "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MIT", "mit", 146, "66ad8f5161202292447bdff60b14561d5670916f3c2197c196052068d16fb83d"),
    ("MIT", "mit", 152, "8ce14f0a25c4f5bd8f64dc7c23b76a49753d55b1f48c5f489768f95f099479f1"),
    ("MIT", "mit", 153, "e0ec1133ffbb2b3ca539cd8d8bbc6938fd001480f955360a7068e62c83bf1782"),
    ("MIT", "mit", 155, "dbeb98bc1b52f75b36c50c47125a7df442beb1e3ffd78827b170c9c8652c8b12"),
    ("MIT", "mit", 165, "35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164"),
    ("MIT", "permission", 144, "e59c728ec568ded283bc8c171698176676a52d4dc62537dc959a34bde883a23d"),
    ("MIT", "permission", 150, "e6ca3cdafe7a31609682cbe23fdbdb1e5ab3f2ce74ed47febde2b734108e3724"),
    ("MIT", "permission", 151, "c6ad8e2d3c4b04b0c8e25afb5297d47ee7aa24eb5b7464ad26423d0d8f9a96cc"),
    ("MIT", "permission", 153, "d1f09d859fef0adbc5bd2ee7c5591c76e3b5eb789b490f2f9e81d67fde977143"),
    ("MIT", "permission", 163, "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c"),
    ("MIT", "the", 147, "e5df284c4caef3cc35c3d8c33c440329347f198d9f2bfe109879e723a486de46"),
    ("MIT", "the", 148, "61f690ebc1b102bbf9cca0466670cd144c26709e5e307c9037eda3dc8085ef99"),
    ("MIT", "the", 153, "cc6b5157cbaf73ddd55d4ce52f74e3013e5f2cadcf0685ef12edf6fefbffeae7"),
    ("MIT", "the", 154, "1674f9ff70210bc824f330ace1cff45c4642b977b843c0615f68f137c853b844"),
    ("MIT", "the", 154, "94dc2756aa068347d32bc82ecd9f7f309e2a0b433f62b5d2ea960fa9d4ded8fb"),
    ("MIT", "the", 155, "5d01a1651a4c284dfbbf1500c7a5c7abb115387c003fbedd1e4624fe9b90b141"),
    ("MIT", "the", 156, "c34fe21a323cbce8af51fc99095db2ec6f28c105d7fc1a499fa7e3f87c5e2eb1"),
    ("MIT", "the", 157, "cac66bac0e5f8f2bfab569dac33a5a76eaf695c630e7615e972455456ebe1ec5"),
    ("MIT", "the", 166, "6ad3654379e72bbdf8478d5c90fb1e2525aba033fbe675e0ef2248aac67c0f6f"),
    ("MIT", "the", 167, "6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127"),
    ("MPL-2.0", "mozilla", 2412, "234f0bf8546624dc0d706aa0d5c4e56a24ece81bfa9b90ca54900e271eef0e01"),
    ("MPL-2.0", "mozilla", 2414, "de0e0bad5657ae87b52462bd6dcfbfa29b0e1c9cdb1af2703a8760bce580dd61"),
)
